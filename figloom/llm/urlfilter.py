"""URL filters: listed canonical URLs, a blocked Bloom filter of them, and an exact join behind it.

A listed entry is `host/path`: it fits its host, the subdomains of that, and every path that begins with its path. The
filter holds all listed URLs and their hosts. Each suffix of a URL's host is looked up first; one that is listed comes with
the lengths of its own entries' paths, and with the beginnings of the URL's path of these lengths it makes the candidates.
The filter lets through the possible hits, one 64-byte block and eight bits each; the joins with the list remove those that
aren't listed, and the longest entry wins (of equal ones, the last in order).

The filter has a fixed number of bytes. A list that outgrows it lets more candidates through to the joins; the result
stays the same. The list is broadcast up to `broadcast_entries`, beyond that both sides of a join are shuffled.

Null URLs and URLs without `://` have an empty host and path and fit nothing, as do URLs without a path; URLs may be of any
length; repeated rows are judged alike and kept; an empty list fits nothing; entries without a host are left out; an empty
table gives an empty result; columns of any other name pass through.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figloom.llm import bloom


def with_host_and_path(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty for a null or one without `://`."""
    url = F.col(url_col)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return df.withColumn("host", F.translate(F.coalesce(host, F.lit("")), upper, lower)).withColumn("path", F.coalesce(path, F.lit("")))


def _possible(keyed: DataFrame, words: np.ndarray) -> DataFrame:
    """keyed (host, path, keys array<string>, hashes array<long>) -> host, path, candidate: the keys that may be listed."""
    shared = keyed.sparkSession.sparkContext.broadcast(words)

    def probe(batches):
        table = shared.value
        for batch in batches:
            hashes = batch.column(3)
            hit = np.flatnonzero(bloom.may_hold(table, hashes.flatten().to_numpy(zero_copy_only=False)))
            if len(hit):
                row = pa.array(np.searchsorted(hashes.offsets.to_numpy() - hashes.offsets[0].as_py(), hit, "right") - 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), batch.column(2).flatten().take(pa.array(hit))], ["host", "path", "candidate"])

    return keyed.withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k))).select("host", "path", "keys", "hashes").mapInArrow(probe, "host string, path string, candidate string")


def judge(urls: DataFrame, listed: DataFrame, default: str = "allow", url_col: str = "url", filter_bytes: int = 1 << 24, broadcast_entries: int = 100_000) -> DataFrame:
    """urls with host, path, rule (the longest listed entry that fits, else null) and verdict (the entry's, else default).

    listed has rule (`host/path`) and verdict."""
    entries = listed.where("instr(rule, '/') > 1").groupBy("rule").agg(F.min("verdict").alias("verdict"))
    hosts = entries.groupBy(F.substring_index("rule", "/", 1).alias("candidate")).agg(F.collect_set(F.length("rule") - F.instr("rule", "/") + 1).alias("lengths"))
    n = entries.count()
    judged = with_host_and_path(urls, url_col)
    if not n:
        return judged.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    words = bloom.build(entries.select("rule").union(hosts.select("candidate")), F.xxhash64("rule"), min(filter_bytes, max(64, 1 << (5 * n).bit_length())))
    small = F.broadcast if n <= broadcast_entries else lambda df: df
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    distinct = judged.where("host != '' and path != ''").select("host", "path").distinct()
    listed_hosts = _possible(distinct.withColumn("keys", suffixes), words).join(small(hosts), "candidate")
    paths = F.transform(F.filter("lengths", lambda x: x <= F.length("path")), lambda x: F.substring("path", F.lit(1), x))
    hits = _possible(listed_hosts.withColumn("keys", F.transform(paths, lambda p: F.concat("candidate", p))), words).withColumnRenamed("candidate", "rule")
    exact = hits.join(small(entries), "rule")
    best = exact.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    best = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    clash = [c for c in ("rule", "verdict") if c in urls.columns]
    # Rows that no entry can fit are left out of the join: they would all meet under one key.
    judged = judged.drop(*clash)
    out = judged.where("host != '' and path != ''").join(best, ["host", "path"], "left")
    rest = judged.where("host = '' or path = ''").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    return out.unionByName(rest).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
