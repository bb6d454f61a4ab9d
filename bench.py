"""Headline benchmark: runs the main jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]
and prints one JSON line.

Each query is executed to completion with the no-op sink (every row is
produced, nothing is collected).  The metric is the sum of the query times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_articles",
    "build_vocab",
    "encode",
    "decode",
    "next_token_windows",
    "sample_windows",
    "matrix_multiply",
    "row_softmax",
    "sample_next",
    "forward_logits",
    "window_loss",
    "evaluate",
    "train_batch",
    "generate_batch",
    "stream_vocab",
]


def throughput(spark, sf_dir: str, times: dict) -> dict:
    """Rates over the timed queries, from counts taken after the timings
    (whole-query wall time, vocabulary build included)."""
    from pyspark.sql import functions as F

    from wordmill.functions.text import split_words_expr
    from wordmill.plans.generate import CLI_PRESET
    from wordmill.session import read_table

    docs = read_table(spark, sf_dir, "documents")
    tok = docs.select((F.size(split_words_expr(F.col("text"))) + 2).alias("n")).agg(
        F.sum("n").alias("tokens"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("windows")
    ).first()
    bench = read_table(spark, sf_dir, "benchmark")
    evalw = bench.select(F.greatest(F.size(split_words_expr(F.col("text"))) + 1, F.lit(0)).alias("w")).agg(F.sum("w")).first()[0]
    prompts = read_table(spark, sf_dir, "conversations").where(F.col("role") == "user").count()
    rates = {"tokens": int(tok["tokens"]), "windows": int(tok["windows"]), "eval_windows": int(evalw), "prompts": prompts}
    if "encode" in times:
        rates["encode_tokens_per_s"] = round(tok["tokens"] / times["encode"])
    if "next_token_windows" in times:
        rates["windows_per_s"] = round(tok["windows"] / times["next_token_windows"])
    if "window_loss" in times:
        rates["scored_windows_per_s"] = round(evalw / times["window_loss"], 1)
    if "train_batch" in times:
        rates["train_batch_s_incl_setup"] = times["train_batch"]
    if "generate_batch" in times:
        # As if no prompt stopped early.
        rates["generated_tokens_per_s_at_most"] = round(CLI_PRESET.max_new_tokens * prompts / times["generate_batch"], 1)
    return rates


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from wordmill.plans.queries import QUERIES
    from wordmill.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)) if cpus.isdigit() else 16, app="wordmill-bench")
    # warm the JVM (regex, codegen paths) once on the smallest tables, outside the timings
    spark.range(1000).selectExpr("sum(id)").collect()
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        QUERIES["clean_articles"](spark, warm_dir).write.format("noop").mode("overwrite").save()
        QUERIES["encode"](spark, warm_dir).write.format("noop").mode("overwrite").save()
        QUERIES["window_loss"](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    rates = {}
    try:
        rates = throughput(spark, sf_dir, times)
    except Exception as e:  # noqa: BLE001
        errors["throughput"] = f"{type(e).__name__}: {str(e)[:200]}"
    out = {
        "metric": "sum_of_headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }
    if rates:
        out["throughput"] = rates
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
