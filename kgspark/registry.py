"""Schema metadata: entity classes, their attributes and references, as dataclasses and what is derived from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Types of attributes, the type a model is told, and the Spark type.
TYPES = {
    "string": ("string", T.StringType()), "text": ("string", T.StringType()), "enum": ("string", T.StringType()), "integer": ("integer", T.LongType()),
    "float": ("number", T.DoubleType()), "boolean": ("boolean", T.BooleanType()), "json_array": ("array", T.ArrayType(T.StringType())),
}


@dataclass(frozen=True)
class Attribute:
    name: str
    type: str = "string"
    required: bool = False
    source: str = "llm"
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ref:
    """A field that names a record of another class, and the edge it makes; ``many`` fields hold lists."""

    name: str
    target: str
    target_field: str
    edge: str
    many: bool = False


@dataclass(frozen=True)
class Entity:
    name: str
    primary_text: str
    dedup: str = "fuzzy"
    attributes: tuple[Attribute, ...] = ()
    references: tuple[Ref, ...] = ()
    priority: int | None = None
    exclusive_with: tuple[str, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class Phase:
    name: str
    sections: tuple[str, ...]
    extracts: tuple[str, ...]
    gate_entity: str | None = None
    gate_condition: str | None = None


@dataclass
class Registry:
    entities: dict[str, Entity] = field(default_factory=dict)
    phases: list[Phase] = field(default_factory=list)

    @classmethod
    def from_mappings(cls, entities: Mapping, phases: Mapping | None = None) -> Registry:
        """From the mappings of the YAML files, read by the caller."""
        out = cls()
        for name, raw in (entities.get("entities") or entities).items():
            attrs = tuple(Attribute(a["name"], a.get("type", "string"), bool(a.get("required")), a.get("source", "llm"), tuple(a.get("values") or ())) for a in raw.get("attributes") or ())
            refs = tuple(Ref(r["name"], r["target_entity"], r.get("target_field") or "", r.get("edge_type") or r["name"]) for r in raw.get("references") or ())
            inline = tuple(Ref(r.get("via_field") or r["name"], t, "", r["name"], bool(r.get("multiple"))) for r in raw.get("relations") or raw.get("inline_relations") or () for t in (r["target"] if isinstance(r["target"], list) else [r["target"]]))
            out.entities[name] = Entity(name, raw.get("primary_text") or "", raw.get("dedup_mode") or "fuzzy", attrs, refs + inline, raw.get("priority"), tuple(raw.get("mutually_exclusive_with") or ()), raw.get("description") or "")
        for name, raw in ((phases or {}).get("phases") or phases or {}).items():
            gate = raw.get("gate") or {}
            out.phases.append(Phase(name, tuple(raw.get("sections") or ()), tuple(raw.get("extracts") or ()), gate.get("entity"), gate.get("condition")))
        return out

    def global_types(self) -> list[str]:
        """Classes whose ids are shared by all documents."""
        return [n for n, e in self.entities.items() if e.dedup != "article"]

    def model_fields(self, name: str) -> list[Attribute]:
        """What a model fills in; evidence, structure and vocabulary are added later."""
        return [a for a in self.entities[name].attributes if a.source == "llm"]

    def extractable(self) -> list[str]:
        return [n for n in self.entities if self.model_fields(n)]

    def required(self) -> dict[str, list[str]]:
        return {n: [a.name for a in self.model_fields(n) if a.required] for n in self.entities}

    def spark_schema(self, name: str) -> T.StructType:
        return T.StructType([T.StructField(a.name, TYPES.get(a.type, TYPES["string"])[1], not a.required) for a in self.entities[name].attributes])

    def json_schema(self, names: Sequence[str] | None = None) -> dict:
        """The schema of a model's answer: a list of one variant per class; reference fields are allowed too."""
        variants = []
        for n in names or self.extractable():
            props = {a.name: self._json_type(a) for a in self.model_fields(n)} | {r.name: {"type": "string"} for r in self.entities[n].references if r.name not in {a.name for a in self.entities[n].attributes}}
            need = [a.name for a in self.model_fields(n) if a.required]
            attrs = {"type": "object", "properties": props, "required": need, "additionalProperties": False}
            variants.append({"type": "object", "properties": {n: {"type": "string"}, f"{n}_attributes": attrs}, "required": [n, f"{n}_attributes"], "additionalProperties": False})
        return {"type": "object", "properties": {"extractions": {"type": "array", "items": {"anyOf": variants}}}, "required": ["extractions"]}

    @staticmethod
    def _json_type(a: Attribute) -> dict:
        kind = TYPES.get(a.type, TYPES["string"])[0]
        out: dict = {"type": kind}
        if a.type == "enum" and a.values:
            out["enum"] = list(a.values)
        if kind == "array":
            out["items"] = {"type": "string"}
        return out

    def prompt(self, names: Sequence[str], examples: Sequence[tuple[str, str]] = ()) -> str:
        """Instructions for extracting the classes, with worked examples."""
        lines = ["Extract the following entities. Answer with JSON."]
        for n in names:
            lines.append(f"\n{n}: {self.entities[n].description}".rstrip())
            lines += [f"- {a.name} ({a.type}{', required' if a.required else ''}){': ' + ' | '.join(a.values) if a.values else ''}" for a in self.model_fields(n)]
        lines += [f"\nQ: {q}\nA: {a}" for q, a in examples]
        return "\n".join(lines)

    def routing(self) -> dict[str, list[str]]:
        """Classes to extract from each section, in the order of the phases."""
        out: dict[str, list[str]] = {}
        for p in self.phases:
            for s in p.sections:
                out.setdefault(s, []).extend(e for e in p.extracts if e not in out.get(s, []))
        return out

    def reference_columns(self) -> list[tuple[str, str, str, str, str]]:
        """(class, field, target class, target field, edge) of every reference."""
        return [(n, r.name, r.target, r.target_field or self.entities[r.target].primary_text, r.edge) for n, e in self.entities.items() for r in e.references if r.target in self.entities]

    def reference_maps(self) -> tuple[dict[str, list[tuple[str, str, str, str]]], dict[str, list[tuple[str, str, str]]]]:
        """By class what it refers to (field, target class, target field, edge), and what refers to it (class, field, edge)."""
        forward: dict[str, list[tuple[str, str, str, str]]] = {}
        reverse: dict[str, list[tuple[str, str, str]]] = {}
        for cls, name, target, key, edge in self.reference_columns():
            forward.setdefault(cls, []).append((name, target, key, edge))
            reverse.setdefault(target, []).append((cls, name, edge))
        return forward, reverse

    def gate_fields(self, name: str, field_name: str) -> list[str]:
        """The attributes that a gate's field stands for: itself, or, if the class has no such attribute, those enums that
        are filled in after extraction."""
        attributes = self.entities[name].attributes if name in self.entities else ()
        later = [a.name for a in attributes if a.source == "post" and a.type == "enum"]
        return [field_name] if not later or any(a.name == field_name for a in attributes) else later
