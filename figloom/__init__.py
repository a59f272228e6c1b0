"""Figure-dataset analytics as Spark jobs: pages, captions, boxes, scale, tables, search and evaluation."""
