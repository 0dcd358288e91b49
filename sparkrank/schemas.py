"""Schemas of the tables the engine reads and writes."""

DOCUMENT = "_id string, title string, text string"
JUDGMENT = "query_id string, corpus_id string, score int"
METRICS = "query_id string, precision double, recall double, map double"
COLLECTION = (
    "_id string, parent_id string, title string, text string, embedding array<float>, ticker string"
)
RUNS = "run_name string, branch string, ts timestamp, metric string, value double"
RUN_PARAMS = "run_name string, key string, value string"
PROMOTION = (
    "run_name string, promotion_status string, branch string, metric string, "
    "main_score double, new_score double"
)
