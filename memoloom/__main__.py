"""Command line: ``python -m memoloom embed STORE`` encodes trusted labels that have no vector yet."""

from __future__ import annotations

import argparse

from .boundary import HashEncoder
from .config import Settings, load_settings
from .plans.pipeline import embed_new
from .sources.store import Store


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="memoloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    embed = commands.add_parser("embed", help="encode trusted labels that have no vector of this encoder")
    embed.add_argument("store", help="folder of the stored tables")
    embed.add_argument("--settings", help="YAML file of settings")
    embed.add_argument("--run-date", required=True, help="YYYY-MM-DD, kept with the vectors")
    embed.add_argument("--min-confidence", type=float, help="least confidence of scored labels")
    given = parser.parse_args(arguments)

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("memoloom").getOrCreate()
    settings = load_settings(given.settings, given.run_date) if given.settings else Settings(run_date=given.run_date)
    if given.min_confidence is not None:
        settings = settings.updated({"embedding": {"min_confidence": given.min_confidence}})
    print(embed_new(Store(spark, given.store), settings, HashEncoder(), given.run_date), "new vectors")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
