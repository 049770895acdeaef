"""The KPI job as a program: topic to windowed KPIs to keyed documents.

spark-submit zonetally/streaming/main.py --servers HOST:PORT --topic metrics --out DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse

from zonetally import schemas
from zonetally.session import build_session, prepare
from zonetally.sources.readers import file_stream, topic_stream
from zonetally.sources.writers import compact
from zonetally.streaming.jobs import TRIGGER, UNTIL_EMPTY, kpi_job


def main(argv: list[str] | None = None) -> None:
    ask = argparse.ArgumentParser(description=__doc__)
    ask.add_argument("--servers", help="Kafka brokers; without them --files is read")
    ask.add_argument("--topic", default="metrics")
    ask.add_argument("--files", help="folder of text files with one record per line")
    ask.add_argument("--out", required=True)
    ask.add_argument("--checkpoint", required=True)
    ask.add_argument("--compact-to", help="write the newest documents to this folder at the end")
    ask.add_argument("--until-empty", action="store_true", help="end when all records are read")
    args = ask.parse_args(argv)
    spark = prepare(build_session("window-kpis"))
    payloads = topic_stream(spark, args.servers, [args.topic]) if args.servers else file_stream(spark, args.files, args.topic)
    kpi_job(payloads, args.out, args.checkpoint, UNTIL_EMPTY if args.until_empty else TRIGGER).awaitTermination()
    if args.compact_to:
        compact(spark, args.out, "doc_id", schemas.KPI_DOCUMENT, args.compact_to)


if __name__ == "__main__":
    main()
