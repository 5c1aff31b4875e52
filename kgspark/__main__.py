"""Command line: ``python -m kgspark batch INPUT OUT --entities F --phases F --names F --vocabulary CLASS F NAMES TYPE SUBTYPE`` and ``debug FILE``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .config import Settings
from .operators import vocabulary
from .operators.served import extractor_factory
from .registry import Registry
from .sources.articles import parse_article, read_articles
from .sources.tables import read_vocabulary


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser("kgspark")
    sub = p.add_subparsers(dest="what", required=True)
    b = sub.add_parser("batch", help="articles below INPUT to a graph in OUT")
    b.add_argument("input")
    b.add_argument("out")
    b.add_argument("--glob", default="*.xml")
    b.add_argument("--entities", required=True, help="YAML of entity classes")
    b.add_argument("--phases", required=True, help="YAML of phases")
    b.add_argument("--names", help="JSON of names by class for the offline extractor; without it a served model is asked")
    b.add_argument("--model-url", help="address of a service with the chat-completion protocol; the key is in KGSPARK_API_KEY")
    b.add_argument("--model")
    b.add_argument("--passes", type=int)
    b.add_argument("--cache", help="shared folder of answers kept from run to run")
    b.add_argument("--vocabulary", nargs=5, action="append", default=[], metavar=("CLASS", "FILE", "NAMES", "TYPE", "SUBTYPE"), help="tab-separated vocabulary of a class, and its columns of names, class and subclass; may be repeated")
    b.add_argument("--skip-gate", action="store_true")
    d = sub.add_parser("debug", help="what is read from one article")
    d.add_argument("file")
    a = p.parse_args(args)
    if a.what == "debug":
        with open(a.file, "rb") as f:
            print(json.dumps(parse_article(a.file, f.read()), indent=2, ensure_ascii=False))
        return 0
    import yaml

    from .pipeline import deliver, run

    load = lambda path: yaml.safe_load(open(path, encoding="utf-8"))  # noqa: E731, SIM115
    registry = Registry.from_mappings(load(a.entities), load(a.phases))
    names = None
    if a.names:
        with open(a.names, encoding="utf-8") as f:
            names = json.load(f)
    spark = SparkSession.builder.appName("kgspark").getOrCreate()
    vocabularies = {cls: vocabulary.load(read_vocabulary(spark, path), *columns) for cls, path, *columns in a.vocabulary}
    if unknown := sorted(set(vocabularies) - set(registry.entities)):
        p.error(f"vocabularies of unknown classes: {unknown}")
    given = {k: v for k, v in (("model_url", a.model_url), ("model", a.model), ("passes", a.passes), ("cache", a.cache)) if v is not None}
    settings = Settings.load(spark, skip_gate=a.skip_gate, **given)
    result = run(read_articles(spark, a.input, a.glob), registry, extractor_factory(settings, names, registry.json_schema()), settings, vocabularies)
    deliver(result, registry, a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
