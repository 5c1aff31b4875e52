"""The whole chain: articles to mentions, clean mentions to a graph, and the delivery."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .config import Settings
from .functions import evidence as E
from .functions import names as N
from .functions import values as V
from .operators import align, coref, dedup, extract, gate, graph, text, validate, vocabulary
from .registry import Phase, Registry
from .session import checkpointed
from .sources import articles as src
from .sources import sinks

MARK = "\n\nText:\n"
NAMES = ("standard_name", "abbreviation", "site_name", "group_name", "method_name", "breed", "intervention_target", "indicator_abbreviation")


@dataclass
class Result:
    """Tables of a run."""

    mentions: DataFrame
    nodes: DataFrame
    edges: DataFrame
    unresolved: DataFrame
    passed: DataFrame
    failed: DataFrame
    errors: DataFrame


def run_phase(articles: DataFrame, registry: Registry, phase: Phase, number: int, make: Callable[[], extract.Extractor], settings: Settings, context: DataFrame | None = None) -> DataFrame:
    """Mentions (and parse errors) of one phase: its text in chunks, prompts, answers, resolved items of its classes.

    ``context`` (document_id, context) goes into the prompt before the text. Every pass asks all prompts; with a cache,
    answers of earlier runs are taken from it, and a pass is part of an answer's key. The order of a mention is made of
    phase, pass, chunk and place in the answer, so that 'first' means the same in every run.
    """
    texts = reduce(DataFrame.unionByName, (src.phase_text(articles, s) for s in phase.sections)).groupBy("document_id").agg(F.array_join(F.array_distinct(F.collect_list("phase_text")), "\n\n").alias("phase_text"))
    chunks = text.chunk(texts, ["document_id"], "phase_text", settings.chunk_chars)
    chunks = text.previous_context(chunks, "document_id", "chunk_idx", "chunk_text", settings.context_chars) if settings.context_chars else chunks.withColumn("prompt_context", F.lit(""))
    if context is not None:
        chunks = chunks.join(context, "document_id", "left").withColumn("prompt_context", F.concat_ws("\n", F.nullif("prompt_context", F.lit("")), "context"))
    head = registry.prompt(phase.extracts)
    user = F.concat(F.coalesce("prompt_context", F.lit("")), F.lit(MARK), F.col("chunk_text"))
    prompts = chunks.withColumn("prompt", F.concat(F.lit(head + "\n"), user)).crossJoin(F.broadcast(chunks.sparkSession.range(1, settings.passes + 1).withColumnRenamed("id", "pass")))
    keep = ["document_id", "chunk_idx", "pass"]
    if settings.cache:
        how = F.concat_ws("|", F.lit(f"{settings.temperature}|{settings.thinking}"), "pass")
        keyed = prompts.withColumn("key", extract.cache_key(F.lit(settings.model), F.lit(head), user, how))
        answers = extract.AnswerCache(articles.sparkSession, settings.cache).extract(keyed, keep, "prompt", "key", make, batch=settings.batch, retries=settings.retries)
    else:
        answers = extract.extract(prompts, keep, "prompt", make, settings.batch, settings.retries)
    items = extract.resolve_outputs(answers, keep, "output")
    digits = lambda c, n: F.lpad(c.cast("string"), n, "0")
    order = F.concat(F.lit(str(number + 1)), digits(F.col("pass"), 8), digits(F.col("chunk_idx"), 13), digits(F.col("ext_ord") + 1, 13)).cast("decimal(38,0)")
    own = F.col("extraction_class").isNull() | F.col("extraction_class").isin(*phase.extracts)
    # answers are paid for once: they are stored before anything reads them
    return checkpointed(items.where(own).select("document_id", F.lit(phase.name).alias("phase"), F.col("pass").cast("int").alias("pass"), order.alias("ord"), F.col("extraction_class").alias("cls"), F.col("extraction_text").alias("name"), F.coalesce("attributes", F.create_map().cast("map<string,string>")).alias("attributes"), "parse_error"))


def classify(mentions: DataFrame, vocabularies: Mapping[str, DataFrame]) -> DataFrame:
    """Adds classification, subclass and match_source to the mentions of classes with a vocabulary."""
    out = mentions
    for cls, vocab in vocabularies.items():
        m = vocabulary.cascade(out.where(F.col("cls") == cls), "name", vocab).select("name", F.lit(cls).alias("cls"), "entry_class", "entry_subclass", "match_source")
        found = F.map_filter(F.create_map(F.lit("classification"), "entry_class", F.lit("subclass"), "entry_subclass", F.lit("match_source"), "match_source"), lambda k, v: v.isNotNull())
        # names that no tier finds may still contain a key or lie in one
        second = vocabulary.second_pass(m.where("match_source = 'unmatched'"), "name", vocab).withColumnRenamed("entry_class", "second")
        m = m.join(second, "name", "left").withColumns({"match_source": F.when(F.col("second").isNotNull(), "fuzzy").otherwise(F.col("match_source")), "entry_class": F.coalesce("second", "entry_class")})
        joined = out.join(m.withColumn("__more", found).select("name", "cls", "__more"), ["name", "cls"], "left")
        out = joined.withColumn("attributes", F.when(F.col("__more").isNull(), F.col("attributes")).otherwise(F.map_concat(F.map_filter("attributes", lambda k, v: ~k.isin("classification", "subclass", "match_source")), "__more"))).drop("__more")
    return out


def clean(mentions: DataFrame, registry: Registry, settings: Settings) -> DataFrame:
    """Normalised, merged, exclusive and complete mentions: names and attributes cleaned, coreferent mentions of one
    document put together, classes that exclude each other decided, incomplete and unsupported mentions dropped."""
    m = mentions.withColumn("name", V.clean_text(F.col("name"))).withColumn("attributes", E.normalized_attributes(F.col("attributes"), NAMES, V.clean_text))
    m = m.withColumn("name", E.repaired_name(F.col("name"), F.col("evidence_text"), F.col("attributes")["standard_name"])).withColumn("evidence_text", V.clean_evidence(F.col("evidence_text")))
    exact = [n for n, e in registry.entities.items() if e.dedup == "exact"]
    scope = ["document_id", "cls"]
    loose = coref.resolve(m.where(~F.col("cls").isin(*exact)) if exact else m, scope, order="ord", text="name", aliases=coref.alias_map(m.withColumn("abbreviation", F.col("attributes")["abbreviation"]), scope, "name", "abbreviation"))
    if exact:
        loose = loose.unionByName(coref.resolve(m.where(F.col("cls").isin(*exact)), scope, order="ord", text="name", fuzzy=False))
    keyed = checkpointed(loose.withColumn("group_key", F.coalesce("group_key", F.concat(F.lit("#"), F.col("ord").cast("string")))))
    merged = dedup.merge_groups(keyed, [*scope, "group_key"], order="ord", text="name", evidence="evidence_text", attributes="attributes", separator=" <|> ", rule="first", lists=[a.name for e in registry.entities.values() for a in e.attributes if a.type == "json_array"])
    merged = merged.withColumn("attributes", F.coalesce("attributes", F.create_map().cast("map<string,string>")))
    # every text of a group goes on naming it, whichever is kept as its name
    names = keyed.select(*scope, "group_key", F.explode(known_as(registry)).alias("alias")).groupBy(*scope, "group_key").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
    merged = merged.join(names, [*scope, "group_key"], "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    ranks = {n: e.priority for n, e in registry.entities.items() if e.priority is not None}
    if len(ranks) > 1:
        merged = validate.exclusive(merged, ["document_id"], cls="cls", name="name", order="ord", priority=ranks)
    need = registry.required()
    lacks = [F.when((F.col("cls") == c) & (N.nonblank(F.col("attributes")[f]).isNull()), F.lit(f)) for c, fs in need.items() for f in fs if f != registry.entities[c].primary_text]
    if settings.strict and lacks:
        merged = merged.where(F.size(F.filter(F.array(*lacks), lambda x: x.isNotNull())) == 0)
    return merged.where(validate.good_enough(F.col("name"), settings.strict) & N.nonblank(F.col("name")).isNotNull())


def verified(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """Mentions that are borne out by their evidence or document; one found only without its brackets loses them."""
    tiers = validate.verify(mentions, documents, document="document_id", ident="ord", text="name", evidence="evidence_text", body="text")
    m = mentions.join(tiers.where("tier IS NOT NULL"), "ord")
    bare = N.strip(F.regexp_replace("name", r"(?U)\s*\([^)]*\)", ""))
    return m.withColumn("name", F.when(F.col("tier") == 3, bare).otherwise(F.col("name"))).select(*mentions.columns)


def drop_unreferenced(mentions: DataFrame, registry: Registry, classes: Sequence[str]) -> DataFrame:
    """Mentions without those of ``classes`` that no reference of their document names, by name or by any attribute."""
    refs = [r for r in registry.reference_columns() if r[2] in classes]
    if not refs:
        return mentions
    named = reduce(DataFrame.unionByName, (_values(mentions, c, f).select("document_id", F.lit(t).alias("cls"), F.lower(N.strip(F.col("value"))).alias("k")) for c, f, t, _, _ in refs)).where("k <> ''").distinct()
    keys = F.explode(F.array_distinct(F.concat(F.array("name"), F.map_values("attributes")))).alias("alias")
    hit = mentions.where(F.col("cls").isin(*classes)).select("ord", "document_id", "cls", keys).withColumn("k", F.lower(N.strip(F.col("alias")))).join(named, ["document_id", "cls", "k"], "left_semi").select("ord").distinct()
    return mentions.join(hit.withColumn("__hit", F.lit(True)), "ord", "left").where(~F.col("cls").isin(*classes) | F.col("__hit")).drop("__hit")


def create_missing(mentions: DataFrame, registry: Registry, classes: Sequence[str]) -> DataFrame:
    """Mentions and one more for each target of ``classes`` that a document's references name and it lacks, written as it
    is named first, with that reference's order and evidence."""
    out = mentions
    for cls in classes:
        field = registry.entities[cls].primary_text
        refs = [r for r in registry.reference_columns() if r[2] == cls]
        if not refs:
            continue
        named = reduce(DataFrame.unionByName, (_values(mentions, c, f).select("document_id", "phase", "pass", "ord", "evidence_text", "value") for c, f, *_ in refs))
        named = named.withColumn("k", F.lower(N.strip(F.col("value")))).where("k <> ''").groupBy("document_id", "k").agg(F.min_by(F.struct("phase", "pass", "ord", "evidence_text", "value"), "ord").alias("r"))
        have = mentions.where(F.col("cls") == cls).select("document_id", F.explode(F.array_distinct(F.concat(F.array("name"), F.map_values("attributes")))).alias("alias")).select("document_id", F.lower(N.strip(F.col("alias"))).alias("k"))
        new = named.join(have, ["document_id", "k"], "left_anti").select("document_id", "r.*")
        new = new.select("document_id", "phase", "pass", "ord", F.lit(cls).alias("cls"), F.col("value").alias("name"), F.create_map(F.lit(field or "name"), "value").alias("attributes"), F.lit(None).cast("int").alias("start_pos"), F.lit(None).cast("int").alias("end_pos"), F.lit("created").alias("alignment_status"), "evidence_text", F.lit("").alias("source_location"))
        out = out.unionByName(new)
    return out


def _values(mentions: DataFrame, cls: str, field: str) -> DataFrame:
    """Mentions of a class with one row for each ``value`` of a field; a field may hold a JSON list."""
    raw = F.col("attributes")[field]
    each = F.explode(F.coalesce(F.from_json(raw, "array<string>"), F.array(raw))).alias("value")
    return mentions.where((F.col("cls") == cls) & N.nonblank(raw).isNotNull()).select("*", each).where(N.nonblank(F.col("value")).isNotNull())


def identity(registry: Registry) -> Column:
    """What a mention's node is known by: its class's primary attribute if stated, else its name."""
    stated = [F.when(F.col("cls") == n, N.nonblank(F.col("attributes")[e.primary_text])) for n, e in registry.entities.items() if e.primary_text]
    return F.coalesce(*stated, F.col("name"))


def known_as(registry: Registry) -> Column:
    """All texts under which a mention may be referred to: its name, and the attributes by which references name its class."""
    fields = {n: {e.primary_text, "abbreviation", "standard_name"} for n, e in registry.entities.items()}
    for _, _, target, field, _ in registry.reference_columns():
        fields[target].add(field)
    texts = [F.when(F.col("cls") == n, N.nonblank(F.col("attributes")[f])) for n, fs in fields.items() for f in sorted(fs - {""})]
    return F.array_distinct(F.array_compact(F.array(N.nonblank(F.col("name")), *texts)))


def build_graph(mentions: DataFrame, registry: Registry, class_nodes: bool = False, merge_names: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and unresolved references of clean mentions.

    With ``class_nodes`` classified mentions get edges to nodes of their classes. With ``merge_names`` a node whose name
    is another's abbreviation, or its full name, is merged into it: its properties fill the other's gaps, and its edges
    move.

    Nodes are keyed by ``identity``. A reference goes to the mention of its document and target class that is known by
    its text (``aliases``; the mention it is the key of comes first), else to the node that the text itself is the key of.
    References that reach no node of any class they may name are returned, not dropped.
    """
    shared = registry.global_types()
    m = mentions.withColumn("key", identity(registry))
    nodes = graph.nodes(m, document="document_id", cls="cls", name="name", attributes="attributes", order="ord", global_types=shared, key="key")
    nodes = checkpointed(nodes)
    long = m.where(N.nonblank(F.col("name")).isNotNull()).select("document_id", F.col("cls").alias("target"), "key", "ord", F.explode("aliases").alias("alias")).withColumn("form", N.graph_name(F.col("alias")))
    known = long.where("form <> ''").groupBy("document_id", "target", "form").agg(F.min_by("key", F.struct(F.col("form") != N.graph_name(F.col("key")), "ord")).alias("known"))
    refs = []
    for cls, field, target, _, edge in registry.reference_columns():
        r = _values(m, cls, field).where(N.nonblank(F.col("name")).isNotNull())
        source = N.global_id(F.col("cls"), F.col("key"), F.col("document_id"), shared)
        refs.append(r.select(source.alias("s"), F.lit(target).alias("target"), F.lit(field).alias("field"), "value", F.lit(edge).alias("k"), "document_id", "evidence_text", "ord"))
    none = mentions.sparkSession.createDataFrame([], "s string, target string, field string, value string, k string, document_id string, evidence_text string, ord decimal(38,0)")
    every = reduce(DataFrame.unionByName, refs, none).withColumn("form", N.graph_name(F.col("value"))).join(known, ["document_id", "target", "form"], "left")
    every = every.withColumn("t", N.global_id(F.col("target"), F.coalesce("known", "value"), F.col("document_id"), shared))
    every = checkpointed(every.join(nodes.select(F.col("id").alias("t"), F.lit(True).alias("there")), "t", "left"))
    one = ["document_id", "s", "field", "value", "k"]
    unresolved = every.groupBy(*one).agg(F.array_sort(F.collect_set("target")).alias("targets"), F.min("ord").alias("ord"), F.max("there").alias("there")).where("there IS NULL")
    edges = graph.edges(every.where("there AND s <> t"), source="s", target="t", kind="k", document="document_id", evidence="evidence_text", order="ord")
    if class_nodes:
        of = lambda a: F.col("attributes")[a]
        members = m.where((of("classification") != "Other") & N.nonblank(of("classification")).isNotNull()).select(N.global_id(F.col("cls"), F.col("key"), F.col("document_id"), shared).alias("id"), of("classification").alias("c"), of("subclass").alias("sub"), "document_id")
        classes = graph.class_nodes(members, "c", "sub").join(graph.class_documents(members, "c", "document_id"), "id", "left")
        none = F.create_map().cast("map<string,string>")
        nodes = nodes.withColumn("properties", F.coalesce("properties", none)).unionByName(classes.select("id", "label", "name", F.when(F.col("subclass").isNotNull(), F.create_map(F.lit("subclass"), "subclass")).otherwise(none).alias("properties"), "source_pmids"))
        edges = edges.unionByName(graph.belongs_to(members, ident="id", cls="c").select("source_id", "target_id", "type", F.lit(None).cast("string").alias("evidence"), F.lit(None).cast("array<string>").alias("source_pmids")))
    if merge_names:
        p = F.col("properties")
        merged = graph.merge_map(nodes.select("id", "label", "name", p["abbreviation"].alias("abbreviation"), p["standard_name"].alias("full")), ident="id", label="label", name="name", abbreviation="abbreviation", full="full")
        nodes, edges = graph.merge_nodes(nodes, merged), graph.remap(edges, merged)
    return nodes, edges, unresolved.select("document_id", F.col("s").alias("source_id"), "field", "value", F.col("k").alias("type"), "targets", "ord")


def run(articles: DataFrame, registry: Registry, make: Callable[[], extract.Extractor], settings: Settings | None = None, vocabularies: Mapping[str, DataFrame] | None = None, given: Callable[[DataFrame], DataFrame] | None = None) -> Result:
    """Articles through all phases to mentions, graph and gate.

    ``given`` makes mentions of the articles without a model (document_id, cls, name, attributes, evidence_text,
    source_location); if the registry has the class Literature and nothing else is given, the front matter is read.

    A phase with a gate runs first, and only documents that pass it go into later phases, so nothing is asked about the
    others. Mentions are aligned to the article's whole text.
    """
    settings = settings or Settings()
    vocabularies = vocabularies or {}
    going, found, failed = articles, [], articles.select("document_id").limit(0)
    for i, phase in enumerate(sorted(registry.phases, key=lambda p: p.gate_condition is None)):
        context = context_of(reduce(DataFrame.unionByName, found)) if found and settings.reference_context else None
        rows = run_phase(going, registry, phase, i, make, settings, context)
        listed = {c: v for c, v in vocabularies.items() if c in phase.extracts}
        rows = checkpointed(classify(rows, listed)) if listed else rows
        found.append(rows)
        if phase.gate_condition and not settings.skip_gate:
            test = gate.condition(phase.gate_condition, lambda f: F.coalesce(*(N.nonblank(F.col("attributes")[a]) for a in registry.gate_fields(phase.gate_entity, f)), F.lit(None).cast("string")))  # noqa: B023
            passes = (F.col("cls") == phase.gate_entity) & test if test is not None else None
            going, out = gate.split(going, rows, "document_id", passes)
            failed = failed.unionByName(out.select("document_id"))
    rows = reduce(DataFrame.unionByName, found)
    errors = rows.where("parse_error IS NOT NULL").select("document_id", "phase", "parse_error")
    rows = checkpointed(rows.where("cls IS NOT NULL"))
    keep = ["document_id", "phase", "pass", "ord", "cls", "name", "attributes"]
    flat = rows.withColumn("attributes", F.to_json("attributes"))
    documents = src.to_documents(articles)
    placed = align.align(flat, documents, document="document_id", mention="name", text="text", keep=keep, context=settings.evidence_chars)
    placed = checkpointed(placed.withColumn("attributes", F.from_json("attributes", "map<string,string>")))
    if settings.passes > 1:
        placed = checkpointed(align.merge_passes([placed.where(F.col("pass") == p) for p in range(1, settings.passes + 1)], "document_id", "ord", "start_pos", "end_pos"))
    listed = lambda names: [n for n in (x.strip() for x in names.split(",")) if n in registry.entities]
    placed = drop_unreferenced(placed, registry, listed(settings.drop_unreferenced))
    if settings.verify:
        parts = F.array_join(F.transform("sections", lambda s: s["section_text"]), "\n\n")
        placed = verified(placed, documents.join(articles.select("document_id", parts.alias("parts")), "document_id").select("document_id", F.concat_ws("\n\n", "text", "parts").alias("text")))
    given = given or (src.literature if "Literature" in registry.entities else None)
    if given is not None:
        none = F.lit(None).cast("int")
        first = given(articles).select("document_id", F.lit("given").alias("phase"), F.lit(0).alias("pass"), F.lit(0).cast("decimal(38,0)").alias("ord"), "cls", "name", "attributes", none.alias("start_pos"), none.alias("end_pos"), F.lit("given").alias("alignment_status"), "evidence_text", "source_location")
        placed = placed.unionByName(first)
    placed = checkpointed(create_missing(placed, registry, listed(settings.create_missing)))
    mentions = checkpointed(clean(placed, registry, settings).join(going.select("document_id"), "document_id", "left_semi"))
    nodes, edges, unresolved = build_graph(mentions, registry, settings.class_nodes, settings.merge_names)
    return Result(mentions, nodes, edges, unresolved, going.select("document_id"), failed, errors)


def context_of(rows: DataFrame) -> DataFrame:
    """(document_id, context): what earlier phases found in a document, class by class, for the prompts of a later one."""
    named = rows.where("cls IS NOT NULL").select("document_id", "ord", F.concat("cls", F.lit(": "), "name").alias("t"))
    return extract.context_line(named, ["document_id"], F.col("t"), "ord")


def deliver(result: Result, registry: Registry, out: str) -> None:
    """Review tables per class, graph files, manifest and summary below ``out``."""
    for cls in registry.entities:
        m = result.mentions.where(F.col("cls") == cls)
        sinks.write_csv(sinks.review_table(m, ["document_id", "name", "evidence_text"], "attributes", [a.name for a in registry.entities[cls].attributes]), f"{out}/review/{cls}", ["document_id", "name"])
    sinks.write_csv(sinks.all_entities(result.mentions, ["document_id", "cls", "name", "evidence_text"], "attributes"), f"{out}/review/all_entities", ["document_id", "cls", "name"])
    sinks.write_csv(sinks.neo4j_nodes(result.nodes, sinks.property_names(result.nodes)), f"{out}/graph/nodes", ["entity_id:ID"])
    sinks.write_csv(sinks.neo4j_edges(result.edges), f"{out}/graph/edges", [":START_ID", ":END_ID", ":TYPE"])
    sinks.write_csv(result.unresolved.withColumn("targets", F.array_join("targets", "|")), f"{out}/graph/unresolved", ["document_id", "source_id", "field", "value"])
    sinks.write_csv(sinks.manifest(result.passed, result.mentions.withColumnRenamed("name", "first_mention"), "document_id", "ord", ["first_mention"]), f"{out}/manifest", ["document_id"])
    sinks.write_csv(sinks.summary(result.passed, result.failed, result.mentions, "document_id", "cls"), f"{out}/summary", ["item"])
    sinks.write_csv(result.failed, f"{out}/failed", ["document_id"])


def numbered(mentions: DataFrame) -> DataFrame:
    """Mentions with their place in their document."""
    return mentions.withColumn("group_index", F.row_number().over(Window.partitionBy("document_id").orderBy("ord")) - 1)
