"""Settings of a run: defaults, then Spark's configuration under ``kgspark.``, then the environment under ``KGSPARK_``."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """``cache`` is the folder of answers kept from run to run ('' for none); ``drop_unreferenced`` and ``create_missing``
    are comma lists of classes (see the pipeline's functions of those names)."""

    model: str = "offline"
    model_url: str = ""
    temperature: float = 0.1
    thinking: bool = False
    cache: str = ""
    chunk_chars: int = 16000
    batch: int = 32
    passes: int = 1
    context_chars: int = 0
    evidence_chars: int = 300
    retries: int = 3
    skip_gate: bool = False
    verify: bool = True
    merge_names: bool = False
    class_nodes: bool = False
    reference_context: bool = True
    drop_unreferenced: str = ""
    create_missing: str = ""
    strict: bool = False

    @classmethod
    def load(cls, spark: SparkSession | None = None, **given) -> Settings:
        """Values given win; each is cast to its field's type; unknown names are an error."""
        known = {f.name: f.type for f in fields(cls)}
        if unknown := set(given) - set(known):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        cast = {"int": int, "float": float, "str": str, "bool": lambda v: str(v).lower() in ("1", "true", "yes")}
        out = {}
        for name, kind in known.items():
            value = os.environ.get(f"KGSPARK_{name.upper()}")
            if value is None and spark is not None:
                value = spark.conf.get(f"kgspark.{name}", None)
            if value is not None:
                out[name] = cast[kind](value)
        return cls(**(out | given))
