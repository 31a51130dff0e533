"""Secret scan over an incremental blob ledger (operator 4), DataFrame functions only.

A version is a path and its text. Texts are blobs, addressed by SHA-256. The
ledger holds the (blob, rule, rule version) pairs scanned so far and their
findings; only pairs not in it are scanned, each blob once however many paths
or versions carry it, and findings are joined back to all paths.

A rule's matches and the text between them come from two regular-expression
functions; places are running sums of their lengths in code points, taken over
rows of matches, so a text with very many matches needs no long fold.

Defined results: null text is the empty blob; every version row gives one
result row (repeated rows too); rows of one path may carry several texts; texts of
any length are scanned whole; spans that start together go by kind as listed; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written

_VALUE = (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
#: kind: (version, pattern, shortest match, shortest group 1, substring every match holds)
RULES = {
    "assign": (1, _VALUE, 0, 12, None),
    "access": (1, r"AKIA[A-Z0-9]+", 18, 0, "AKIA"),
    "hex": (1, r"[0-9a-f]{16,}", 16, 0, None),
    "github": (1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, "gh"),
    "slack": (1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, "xox"),
    "jwt": (1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0, "eyJ"),
    "private_key": (1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, "-----BEGIN"),
}
BASE = ("assign", "access", "hex")
LEDGER = ("blob binary, rule string, rule_version int, "
          "found array<struct<start:long,end:long>>")


def _blob(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _matches(kind: str) -> Column:
    """The rule's matches and the text before each, where it is asked for."""
    _, pattern, *_, holds = RULES[kind]
    asked = F.array_contains("rules", kind) & F.col("text").rlike(pattern)
    if holds:
        asked = F.array_contains("rules", kind) & F.contains("text", F.lit(holds)) & asked
    found = F.regexp_extract_all("text", F.lit(pattern), 0)
    return F.struct(F.lit(kind).alias("rule"), F.when(asked, F.arrays_zip(
        found.alias("m"), F.slice(F.split("text", pattern, -1), 1, F.size(found)).alias("g"))
        ).alias("hits"))


def _kept() -> Column:
    out = F.lit(False)
    for kind, (_, pattern, shortest, value, _) in RULES.items():
        ok = F.char_length("m") >= shortest
        if value:
            ok = ok & (F.char_length(F.regexp_extract("m", pattern, 1)) >= value)
        out = F.when(F.col("rule") == kind, ok).otherwise(out)
    return out


def scan(versions: DataFrame, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(paths, ledger): (path, blob) of every version row of ``versions`` (path,
    text), and the ledger with all pairs of its blobs added."""
    spark = versions.sparkSession
    ship(spark)
    named = versions.select("path", F.coalesce("text", F.lit("")).alias("text"), _blob("text").alias("blob"))
    paths = written(named.select("path", "blob"), "paths")
    rules = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(v[0]).alias("rule_version"))
                                for k, v in RULES.items()])).alias("r")
    pairs = paths.groupBy("blob").agg(F.min("path").alias("one")).select("blob", "one", rules).select(
        "blob", "one", "r.*")
    if ledger is not None:
        pairs = pairs.join(ledger.select("blob", "rule", "rule_version"),
                           ["blob", "rule", "rule_version"], "left_anti")
    unseen = pairs.groupBy("blob", "one").agg(F.collect_set("rule").alias("rules"))  # at most len(RULES)
    texts = (named.join(unseen.hint("shuffle_hash"), "blob").where(F.col("path").eqNullSafe(F.col("one")))
             .select("blob", "text", "rules"))
    hits = written(texts.select("blob", F.explode(F.array(*map(_matches, RULES))).alias("x"))
                   .where("x.hits is not null").distinct()
                   .select("blob", "x.rule", F.posexplode("x.hits").alias("i", "h"))
                   .select("blob", "rule", "i", "h.m", F.char_length("h.g").alias("ahead")), "hits")
    upto = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("m")
    spans = (hits.withColumn("end", F.sum(F.col("ahead") + size).over(upto))
             .withColumn("start", F.col("end") - size).where(_kept())
             .groupBy("blob", "rule").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("found")))
    new = (pairs.select("blob", "rule", "rule_version").join(spans, ["blob", "rule"], "left")
           .select("blob", "rule", "rule_version", F.coalesce(
               "found", F.expr("cast(array() as array<struct<start:long,end:long>>)")).alias("found")))
    return paths, new if ledger is None else ledger.unionByName(new)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def findings(paths: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per version row: path, counts of base kinds, base_sha256 and all spans,
    from the ledger's newest rule versions."""
    now = F.lit(False)
    place = F.lit(0)
    for k, (kind, rule) in enumerate(RULES.items()):
        now = now | ((F.col("rule") == kind) & (F.col("rule_version") == rule[0]))
        place = F.when(F.col("rule") == kind, k).otherwise(place)
    spans = (ledger.where(now & (F.size("found") > 0))
             .select("blob", F.transform("found", lambda x: F.struct(
                 x["start"].alias("start"), place.alias("place"), x["end"].alias("end"),
                 F.col("rule").alias("kind"))).alias("one"))
             .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("one"))).alias("all")))
    rows = paths.join(spans, "blob", "left").withColumn("all", F.coalesce("all", F.expr(
        "cast(array() as array<struct<start:long,place:int,end:long,kind:string>>)")))
    base = F.filter("all", lambda x: x["kind"].isin(*BASE))
    return rows.select(
        "path", *[F.expr(f"cast(size(filter(all, x -> x.kind = '{k}')) as long)").alias(f"n_{k}")
                  for k in BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"))


def secret_findings(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) as a version, with an empty ledger."""
    paths, ledger = scan(docs.select(F.col("doc_id").alias("path"), "text"))
    return findings(paths, ledger).withColumnRenamed("path", "doc_id")


def _oracle() -> str:
    parts = []
    for place, (kind, (_, pattern, shortest, value, _)) in enumerate(RULES.items()):
        p = pattern.replace("'", "''")
        ok = f"length(m) >= {shortest}" + (f" AND length(regexp_extract(m, '{p}', 1)) >= {value}" if value else "")
        parts.append(f"""SELECT doc_id, rid, {place} AS place, '{kind}' AS kind, m, i,
          sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) AS e, ({ok}) AS ok FROM (
          SELECT doc_id, rid, unnest(regexp_extract_all(text, '{p}', 0)) AS m,
                 unnest(list_slice(string_split_regex(text, '{p}'), 1,
                        len(regexp_extract_all(text, '{p}', 0)))) AS g,
                 unnest(range(len(regexp_extract_all(text, '{p}', 0)))) AS i
          FROM d WHERE regexp_matches(text, '{p}'))""")
    base = ", ".join(f"'{k}'" for k in BASE)
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(parts)}),
s AS (SELECT rid, place, kind, CAST(e - length(m) AS BIGINT) AS a,
             kind || ':' || CAST(e - length(m) AS BIGINT) || ':' || CAST(e AS BIGINT) AS t FROM m WHERE ok)
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
       sha256(coalesce(string_agg(t, ',' ORDER BY a, place) FILTER (kind IN ({base})), '')) AS base_sha256,
       coalesce(string_agg(t, ',' ORDER BY a, place), '') AS spans
FROM d LEFT JOIN s USING (rid) GROUP BY d.rid, d.doc_id"""


ORACLE = _oracle()
