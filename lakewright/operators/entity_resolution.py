"""Tiered entity resolution: who a source record is, by tax id, own chart, partner chart or birth date, confirmed by name.

Both sides are normalised once; every tier is an equi join, so candidates come
from hash or merge joins only; names are scored once per distinct pair, and
Jaro-Winkler, a Python function, runs only on pairs that need it: those of direct-id candidates that
the cheap score rejects. One window picks the best match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import PREPOSITIONS, jaro_winkler, name_score
from ..functions.text import name_full, name_words, phonetic_fold
from ..functions.values import tax_id
from ..session import materialise
from .reshape import discover_roles, unpivot_links, unpivot_roles

COUPLE = 0.72


def prepare_source(df: DataFrame, id_col: str, name_col: str, birth_col: str | None = None, tax_col: str | None = None, chart_col: str | None = None) -> DataFrame:
    """source_id, source_number, name, birth, tax, original_chart, words, full, fold; rows without an id are left out."""
    null = F.lit(None)
    rows = df.select(
        F.col(id_col).cast("string").alias("source_id"),
        F.col(id_col).cast("string").try_cast("long").alias("source_number"),
        F.col(name_col).alias("name"),
        (F.col(birth_col).cast("string").try_cast("date") if birth_col else null.cast("date")).alias("birth"),
        (tax_id(F.col(tax_col)) if tax_col else null.cast("string")).alias("tax"),
        (F.col(chart_col).cast("string").try_cast("long") if chart_col else null.cast("long")).alias("original_chart"),
    )
    rows = rows.where(F.trim("source_id") != "").distinct()
    rows = rows.withColumns({"words": name_words(F.col("name")), "full": name_full(F.col("name"))})
    return rows.withColumn("fold", phonetic_fold(F.get("words", F.lit(0))))


def prepare_people(patients: DataFrame, code: str = "codigo", links: list[str] | None = None, inactive: str = "inativo") -> DataFrame:
    """One row per chart, role and link: chart, link_id, priority, role, cand_* columns, and the names of all people of the chart (roles).

    A chart's own code links all its roles with priority 1; a link column links
    its own role with the role's priority.
    """
    roles = discover_roles(patients.columns)
    names = [f"{r}_nome" for r in roles]
    folded = patients.withColumns({n: F.col(n).cast("string") for n in names})
    links = [c for c in (links or []) if c in patients.columns]
    everyone = F.array(*[F.col(n) for n in names])
    base = folded.select(F.col(code).cast("long").alias("chart"), F.coalesce(F.col(inactive).cast("string"), F.lit("0")).alias("inactive"), everyone.alias("roles"), *[c for c in folded.columns if c.startswith(tuple(f"{r}_" for r in roles))], *links)
    people = unpivot_roles(base, ["chart", "inactive", "roles"], list(roles), ["nome", "cpf", "nascimento"])
    own = people.select("*", F.col("chart").alias("link_id"), F.lit(1).alias("priority"))
    if links:
        role_of = {c: next((r for r in sorted(roles, key=len, reverse=True) if r in c), None) for c in links}
        each = unpivot_links(base.select("chart", *[F.col(c).cast("long").alias(c) for c in links]), ["chart"], links, "column", "link_id")
        table = F.create_map(*[F.lit(x) for c, r in role_of.items() if r for x in (c, r)])
        each = each.withColumn("role", F.try_element_at(table, F.col("column"))).select("chart", "role", "link_id").distinct()
        rank = F.create_map(*[F.lit(x) for r, p in roles.items() for x in (r, p)])
        linked = people.join(each, ["chart", "role"]).withColumn("priority", F.element_at(rank, F.col("role"))).select(own.columns)
        own = own.unionByName(linked)
    birth = F.coalesce(F.try_to_date("nascimento", "d/M/yyyy"), F.col("nascimento").try_cast("date"))
    out = own.where(F.col("nome").isNotNull()).select("chart", "inactive", "role", "link_id", "priority", "roles", F.col("nome").alias("cand_name"), tax_id(F.col("cpf")).alias("cand_tax"), birth.alias("cand_birth"))
    out = out.withColumns({"cand_words": name_words(F.col("cand_name")), "cand_full": name_full(F.col("cand_name"))})
    return out.withColumns({"cand_fold": phonetic_fold(F.get("cand_words", F.lit(0))), "roles": F.array_distinct("roles")})


def candidates(source: DataFrame, people: DataFrame) -> DataFrame:
    """All (source, person) pairs of the four tiers, with their tier."""
    s, p = source.alias("s"), people.alias("p")
    by_id = s.join(p, F.col("s.source_number") == F.col("p.link_id"))
    same_month = (F.day("s.birth") == 1) & (F.trunc("s.birth", "month") == F.trunc("p.cand_birth", "month"))
    born = F.col("s.tax").isNull() & ((F.col("s.birth") == F.col("p.cand_birth")) | same_month)
    columns = [*[f"s.{c}" for c in source.columns], *[f"p.{c}" for c in people.columns]]
    # one join by id serves three tiers
    tiers = F.filter(F.array(F.when(born, 2), F.when(F.col("p.priority") == 1, 0), F.when(F.col("p.priority") >= 2, 3)), lambda t: t.isNotNull())
    linked = by_id.select(*columns, F.explode(tiers).alias("tier"))
    taxed = s.join(p, F.col("s.tax") == F.col("p.cand_tax")).select(*columns, F.lit(1).alias("tier"))
    return linked.unionByName(taxed)


def score_names(pairs: DataFrame) -> DataFrame:
    """Distinct (name, nome, direct) with `score`, and `couple_score` where the id is direct.

    Words, folds and scores are computed once per pair of names, however many
    candidates share it; Jaro-Winkler only where all else fails and the id is direct.
    """
    words = pairs.withColumns({"p": name_words(F.col("name")), "c": name_words(F.col("nome"))})
    folded = words.withColumns({"pf": phonetic_fold(F.get("p", F.lit(0))), "cf": phonetic_fold(F.get("c", F.lit(0)))})
    scored = folded.withColumn("score", name_score(*map(F.col, ("p", "c", "pf", "cf"))))
    # the couple rule adds evidence for the first name; what follows from the words is as in the score
    shared = F.filter("p", lambda w: F.array_contains("c", w))
    strong = F.size(F.filter(shared, lambda w: ~w.isin(PREPOSITIONS))) >= 2
    unsure = F.col("direct") & (F.col("score") == 5) & (F.size("p") > 0) & (F.size("c") > 0) & strong
    settled = scored.withColumn("unsure", F.coalesce(unsure, F.lit(False)))
    couple = jaro_winkler(name_full(F.col("name")), name_full(F.col("nome"))) >= COUPLE
    better = F.when(F.array_contains("c", F.try_element_at("p", F.lit(-1))), 2).when(F.size(shared) > 1, 3).otherwise(4)
    rescored = settled.where("unsure").withColumn("couple_score", F.when(couple, better).otherwise(5))
    return settled.where("NOT unsure").withColumn("couple_score", F.col("score")).unionByName(rescored).select("name", "nome", "score", "couple_score")


def resolve(source: DataFrame, people: DataFrame) -> DataFrame:
    """source_id, name, chart (-1: none), tier, score, matched_name: one row per source id and name.

    A candidate scores as the best of the names of its chart. Ids and names are
    joined first, written once, and their distinct pairs of names scored.
    """
    s = source.select("source_id", "source_number", "name", "tax", "birth", "original_chart")
    p = people.select("chart", "inactive", "link_id", "priority", "roles", "cand_name", "cand_tax", "cand_birth")
    each = candidates(s, p).withColumn("nome", F.explode("roles")).withColumn("direct", F.col("tier").isin(0, 3))
    each = materialise(each.drop("roles", "tax", "birth", "cand_tax", "cand_birth"), "er-candidates")
    names = score_names(each.groupBy("name", "nome").agg(F.max("direct").alias("direct"))).withColumnsRenamed({"name": "__n", "nome": "__c"})
    scored = each.join(names, F.col("name").eqNullSafe(F.col("__n")) & F.col("nome").eqNullSafe(F.col("__c")))
    scored = scored.withColumn("score", F.when(F.col("direct"), F.col("couple_score")).otherwise(F.col("score"))).where("score < 5")
    best = Window.partitionBy("source_id", "name").orderBy(
        F.col("tier"), F.when(F.col("inactive") == "0", 0).otherwise(1), F.when(F.col("link_id") == F.col("source_number"), 0).otherwise(1), F.col("score"), F.col("priority"),
        F.when(F.col("chart") == F.col("original_chart"), 0).otherwise(1), F.col("chart").desc(), F.col("cand_name").asc_nulls_last(),
    )
    top = scored.withColumn("__rank", F.row_number().over(best)).where("__rank = 1").select(F.col("source_id").alias("__id"), F.col("name").alias("__name"), "chart", "tier", "score", F.col("cand_name").alias("matched_name"))
    keys = source.select("source_id", "name").distinct()
    joined = keys.join(top, (keys["source_id"] == top["__id"]) & keys["name"].eqNullSafe(top["__name"]), "left")
    return joined.select("source_id", "name", F.coalesce("chart", F.lit(-1)).cast("long").alias("chart"), F.col("tier").cast("long").alias("tier"), F.col("score").cast("long").alias("score"), "matched_name")


def fill_unmatched(target: DataFrame, matches: DataFrame, id_col: str, chart_col: str) -> DataFrame:
    """target with its charts that are null or -1 replaced by the matched ones, by id only."""
    from .dedup import update_from

    found = matches.where("chart <> -1").groupBy(F.col("source_id").alias("__key")).agg(F.min_by("chart", F.struct("tier", "score", "chart")).alias(chart_col))
    keyed = target.withColumn("__key", F.col(id_col).cast("string"))
    return update_from(keyed, found, ["__key"], [chart_col], F.col(chart_col).isNull() | (F.col(chart_col) == -1)).drop("__key")


def link_scored_match(source: DataFrame, people: DataFrame, links: list[str], name_parts: list[str]) -> DataFrame:
    """Best chart per source id over many link columns, active people first.

    Score: name 0 (first and last word), 2 (first), 4 (any other equality) plus the link
    column's rank (odd numbers from 1); least wins, then the larger chart. At
    least the first name must agree.
    """
    each = unpivot_links(people, ["chart", "inactive", *name_parts], links, "link", "link_id")
    rank = F.create_map(*[F.lit(x) for i, c in enumerate(links) for x in (c, 2 * i + 1)])
    joined = source.alias("s").join(each.alias("p"), F.col("s.source_number") == F.col("p.link_id"))
    first, last = F.get("s.words", F.lit(0)), F.try_element_at("s.words", F.lit(-1))
    words = F.array(*[F.get(name_words(F.col(f"p.{n}")), F.lit(0)) for n in name_parts])
    lasts = F.array(*[F.try_element_at(name_words(F.col(f"p.{n}")), F.lit(-1)) for n in name_parts])
    hit = F.array_contains(words, first)
    name = F.when(hit & F.array_contains(lasts, last), 0).when(hit, 2).otherwise(4)
    scored = joined.where(hit).withColumn("score", name + F.element_at(rank, F.col("link")))
    order = Window.partitionBy("source_id").orderBy(F.when(F.coalesce(F.col("inactive"), F.lit("0")) == "0", 0).otherwise(1), "score", F.col("chart").desc())
    return scored.withColumn("__r", F.row_number().over(order)).where("__r = 1").select("s.source_id", "p.chart", F.col("score").cast("long").alias("score"))


def validation_flags(df: DataFrame) -> DataFrame:
    """df (tax, cand_tax, birth, cand_birth, full, cand_full) with `flags`, a comma list of what speaks against the match."""
    similar = jaro_winkler(F.col("full"), F.col("cand_full"))
    rated = df.withColumn("similarity", similar)
    # a birth day of 1 means that only the month is known
    month = (F.day("birth") == 1) & (F.trunc("birth", "month") == F.trunc("cand_birth", "month"))
    born = F.col("birth").isNotNull() & F.col("cand_birth").isNotNull() & (F.col("birth") != F.col("cand_birth")) & ~month
    flags = [
        F.when(F.col("tax").isNotNull() & F.col("cand_tax").isNotNull() & (F.col("tax") != F.col("cand_tax")), "CPF_MISMATCH"),
        F.when(born & (F.col("similarity") < 0.85), "DOB_MISMATCH"),
        F.when(born & (F.col("similarity") >= 0.85), "DOB_WARNING"),
        F.when(F.col("similarity") < 0.75, "NAME_MISMATCH"),
    ]
    return rated.withColumn("flags", F.array_join(F.array_compact(F.array(*flags)), ","))


def conflicting_names(df: DataFrame, keys: list[str], name: str, least: float = 0.80) -> DataFrame:
    """Keys that hold two names less alike than `least`: an equi self join on the keys, the fuzzy test on what is left."""
    names = df.select(*keys, name_full(F.col(name)).alias("full")).where(F.col("full") != "").distinct()
    a, b = names.withColumnRenamed("full", "a"), names.withColumnRenamed("full", "b")
    pairs = a.join(b, keys).where("a < b").withColumn("similarity", jaro_winkler(F.col("a"), F.col("b")))
    return pairs.where(F.col("similarity") < least)
