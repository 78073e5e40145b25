"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each job is fully materialised with the ``noop`` sink (no collect). Prints
one JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf", "throughput"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tokenmill.plans.registry import load_all  # noqa: E402
from tokenmill.session import get_spark  # noqa: E402

HEADLINE = [
    "packing_report",          # flagship: split, crop, byte lengths, five packers
    "pack_bestfit_crop_rows",  # best-fit plan + JVM-side row assembly
    "chunk_stream",
    "pretoken_histogram",
    "byte_tokens",
    "clean_transcript",
    "render_conversation",
    "bits_per_byte",
    "pass_at_k",
    "isoflop_fit",
    "scrape_run_logs",
    "normalize_content",
    "verify_tool_calls",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="tokenmill-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    queries, _ = load_all()
    # warm-up (JIT, Python workers) on the smallest scale; not timed
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in ("packing_report", "clean_transcript"):
            queries[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    packing = []
    for name in HEADLINE:
        if name not in queries:
            continue
        t0 = time.time()
        df = queries[name](spark, sf_dir)
        if name == "packing_report":          # tiny result: keep it for the crop / pad report
            packing = [r.asDict() for r in df.collect()]
        else:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    # BPE encoding throughput: merges learnt (untimed) on the smallest corpus,
    # then the whole sf corpus encoded once per distinct piece and re-assembled
    from tokenmill.operators import tokenizer as TK
    from tokenmill.plans.catalog import load
    if os.path.isdir(warm):
        merges = TK.train_bpe(TK.pretoken_histogram(load(spark, warm).documents), 256 + 9 + 64)
        enc = TK.encode_bpe(load(spark, sf_dir).documents, merges).cache()
        t0 = time.time()
        enc.write.format("noop").mode("overwrite").save()
        times["encode_bpe_64"] = round(time.time() - t0, 3)
        n_tok = enc.selectExpr("sum(size(ids))").first()[0]
        enc.unpersist()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n_docs, n_bytes = docs.selectExpr("count(*)", "sum(octet_length(text))").first()
    thr = {}
    if "packing_report" in times:
        thr["packing_report_docs_per_s"] = round(n_docs / times["packing_report"], 1)
        thr["packing_report_mb_per_s"] = round(n_bytes / 1e6 / times["packing_report"], 2)
    if "pretoken_histogram" in times:
        thr["pretoken_mb_per_s"] = round(n_bytes / 1e6 / times["pretoken_histogram"], 2)
    if "clean_transcript" in times:
        thr["clean_docs_per_s"] = round(n_docs / times["clean_transcript"], 1)
    if "encode_bpe_64" in times:
        thr["bpe_encode_tokens_per_s"] = round(n_tok / times["encode_bpe_64"], 1)
    if "byte_tokens" in times:
        thr["byte_tokens_per_s"] = round((n_bytes + n_docs) / times["byte_tokens"], 1)
    if packing:
        tr = [r for r in packing if r["split"] == "train"]
        thr["packing_T2048_train"] = {r["packer"]: {"util_pct": round(r["util_pct"], 2),
                                                    "crop_pct": round(r["crop_pct"], 2),
                                                    "pad_pct": round(r["pad_pct"], 2)} for r in tr}
        rows = sum(r["rows"] for r in packing)
        thr["packing_report_rows_per_s"] = round(rows / times["packing_report"], 1)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "throughput": thr, "warmup": "sf0.001 packing_report + clean_transcript, untimed"}))
    spark.stop()


if __name__ == "__main__":
    main()
