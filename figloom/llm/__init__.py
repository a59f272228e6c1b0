"""Operations of a training-data pipeline: URL filters, near-duplicates, passages, leaks, languages, tokens, toxicity, language models, chats, rules."""
