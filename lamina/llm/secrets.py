"""Secret scans (op 9) over an incremental blob ledger.

Every version of a text is addressed by the SHA-256 of its content. The ledger holds the (blob, rule version)
pairs that were scanned before; only unseen pairs are scanned, each blob once however many paths have it, and
the findings are joined back to all paths. A rule whose version changes is scanned anew. ``scan_stored`` keeps
the ledger and the findings as Parquet in a shared folder: read, met with the delivery, appended to.

Rules: a kind, a pattern, the group that must have ``least`` characters, and a version. Matches are leftmost and
do not overlap within a kind; those with a shorter group are dropped, but what they cover stays consumed.
Places are code points, the end exclusive; they follow from the lengths of the matches and of the texts
between them.

Defined results: a null text is an empty one; repeated rows are paths of one blob; spans of equal start stand in
the order of the rules; very long texts are scanned whole; an empty table gives an empty result. Equal blobs of
null and empty text are one blob. Other columns are not read, so their names cannot clash; paths may be of any type.

Scale: the first pass hashes texts and counts (blob, least path) with map-side aggregation. The second sends
the texts, by (blob, path), to the unseen blobs' representatives in a semi join that needs no sort while a task's
share of them is small, then scans each in place. Findings, a row for each blob that has any, are joined to the
paths with an exchange directly on either side, so a blob with a third of all paths is split by adaptive execution.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import blank, cut, hash_side, shared_folder, table, where_fenced


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int
    least: int
    version: str
    #: One of these stands in every match, whatever its case if the pattern leaves it open; none: not known.
    needles: tuple[str, ...] = ()


#: The base rules, in the order that breaks ties of equal starts, and those that this operator adds. A private key is
#: covered to its end line, if it has one.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, "1"),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, "1", ("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, "1"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=:,.\x20\t\r\n-]*?-----END [A-Z ]*PRIVATE KEY-----)?", 0, 1, "2", ("PRIVATE KEY-----",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "1", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", 0, 15, "1", ("xox",)),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}", 0, 39, "1", ("AIza",)),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}", 0, 24, "1", ("k_live_",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 29, "1", ("eyJ",)),
    Rule("login", r"[a-z][a-z0-9+.-]{1,20}://[^/:@\x00-\x20]{1,64}:([^/@\x00-\x20]{1,128})@", 1, 3, "1", ("://",)),
)
BASE = ("assign", "access", "hex")
SPAN = "array<struct<start:int,rank:int,kind:string,stop:int>>"

BLOB, TEXT = blank("blob"), blank("text")


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of a rule in a text, in order."""
    pattern = F.lit(rule.pattern)
    parts = F.transform(F.split(text, rule.pattern), lambda x: F.length(x))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x))
    group = whole if rule.group == 0 else F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x))
    each = F.zip_with(F.slice(parts, 1, F.size(whole)), F.arrays_zip(whole.alias("whole"), group.alias("group")), lambda p, m: F.struct(p.alias("gap"), m["whole"].alias("whole"), m["group"].alias("group")))
    start = F.struct(F.lit(0).alias("at"), F.expr("array()").cast(SPAN).alias("out"))
    step = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["whole"]).alias("at"),
        F.when(
            x["group"] >= rule.least,
            F.concat(
                acc["out"],
                F.array(F.struct((acc["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (acc["at"] + x["gap"] + x["whole"]).alias("stop"))),
            ),
        )
        .otherwise(acc["out"])
        .alias("out"),
    )
    there = text.rlike(rule.pattern)
    if rule.needles:
        some = F.contains(text, F.lit(rule.needles[0]))
        for needle in rule.needles[1:]:
            some = some | F.contains(text, F.lit(needle))
        there = some & there
    return F.when(there, F.aggregate(each, start, step)["out"]).otherwise(F.expr("array()").cast(SPAN))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...], pending: str = "pending") -> DataFrame:
    """(blob, spans) of blobs with any span; ``pending`` names the kinds to scan in each, null: all."""
    wanted = lambda kind: F.col(pending).isNull() | F.array_contains(pending, kind)
    found = [F.when(wanted(r.kind), spans_of(F.col(TEXT), r, rank)).otherwise(F.expr("array()").cast(SPAN)) for rank, r in enumerate(rules)]
    return where_fenced(blobs.select(F.col(BLOB).alias("blob"), F.concat(*found).alias("spans")), F.size("spans") > 0)


def addressed(docs: DataFrame, path: str, text: str) -> DataFrame:
    own = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(path).alias("path"), F.unhex(F.sha2(own, 256)).alias(BLOB), own.alias(TEXT))


def fresh_pairs(paths: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """(blob, least, pending): the blobs with a rule version that the ledger lacks, the least path of each, and the kinds; null: all."""
    least = paths.groupBy("blob").agg(F.min("path").alias("least"))
    if ledger is None:
        return least.withColumn("pending", F.lit(None).cast("array<string>"))
    kinds = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    active = ledger.where(F.array_contains(kinds, F.struct("kind", "version")))
    had = active.groupBy("blob").agg(F.collect_set("kind").alias("had"))
    lacking = F.array_except(F.array(*[F.lit(r.kind) for r in rules]), F.coalesce("had", F.expr("array()").cast("array<string>")))
    met = least.join(had, "blob", "left").select("blob", "least", F.when(F.col("had").isNotNull(), lacking).alias("pending"))
    return met.where("pending IS NULL OR size(pending) > 0")


def pairs_of(unseen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, version) of the blobs that fresh_pairs tells."""
    kinds = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    mine = F.filter(kinds, lambda x: F.col("pending").isNull() | F.array_contains("pending", x["kind"]))
    return unseen.select("blob", F.explode(mine).alias("x")).select("blob", "x.kind", "x.version")


def scan_new(docs: DataFrame, path: str, text: str, rules: tuple[Rule, ...], ledger: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(paths, unseen, spans of the unseen blobs)."""
    versions = addressed(docs, path, text)
    paths = versions.select("path", F.col(BLOB).alias("blob"))
    unseen = hash_side(fresh_pairs(paths, rules, ledger))
    chosen = versions.join(unseen, (versions[BLOB] == unseen["blob"]) & versions["path"].eqNullSafe(unseen["least"]))
    # Equal rows of one path were scanned each; one of their equal findings stays.
    found = scan_blobs(chosen.select(BLOB, TEXT, "pending"), rules).groupBy("blob").agg(F.max("spans").alias("spans"))
    return paths, unseen, found


def by_path(paths: DataFrame, found: DataFrame) -> DataFrame:
    return paths.join(found, "blob", "left").select("path", "blob", F.coalesce("spans", F.expr("array()").cast(SPAN)).alias("spans"))


def gathered(spans: DataFrame) -> DataFrame:
    """(blob, spans) in order, from (blob, s)."""
    return spans.groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("spans"))


def scan(
    docs: DataFrame, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None, known: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(findings by path, ledger, findings by blob) after scanning what the ledger has not seen.

    Findings by path: path, blob, spans, a row for each row of docs. ``ledger`` (blob, kind, version) and
    ``known`` (blob, spans) are those of earlier runs, or None; what is returned includes them.
    """
    paths, unseen, found = scan_new(docs, path, text, rules, ledger)
    seen = pairs_of(unseen, rules)
    seen = seen if ledger is None else ledger.unionByName(seen)
    if known is not None:
        active = F.array(*[F.lit(f"{r.kind}") for r in rules])
        old = known.select("blob", F.explode("spans").alias("s")).where(F.array_contains(active, F.col("s.kind")))
        rescanned = pairs_of(unseen, rules).select("blob", "kind")
        stays = old.join(rescanned, (old["blob"] == rescanned["blob"]) & (old["s.kind"] == rescanned["kind"]), "left_anti")
        found = stays.select("blob", "s").unionByName(found.select("blob", F.explode("spans").alias("s")))
        found = gathered(found)
    found = cut(found.select("blob", F.sort_array("spans").alias("spans")))
    return by_path(paths, found), seen, found


def stored(spark, folder: str, name: str, schema: str) -> DataFrame | None:
    """A table of a stored ledger, or None where nothing was ever appended."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(schema).parquet(f"{folder}/{name}")


def scan_stored(docs: DataFrame, folder: str, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings by path of a delivery, after its unseen pairs were scanned and appended to the ledger in a shared folder.

    Findings are appended first: a run that is lost between the two appends is repeated by the next, and equal
    findings count once. Findings carry the version of their rule, so those of former versions do not come back.
    """
    spark = docs.sparkSession
    ledger = stored(spark, folder, "ledger", "blob binary, kind string, version string")
    paths, unseen, found = scan_new(docs, path, text, rules, ledger)
    versions = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    found.select("blob", F.explode("spans").alias("s")).withColumn("version", versions[F.col("s.kind")]).write.mode("append").parquet(f"{folder}/findings")
    pairs_of(unseen, rules).write.mode("append").parquet(f"{folder}/ledger")
    known = stored(spark, folder, "findings", f"blob binary, s {SPAN.removeprefix('array<').removesuffix('>')}, version string")
    ranks = F.create_map(*[F.lit(x) for rank, r in enumerate(rules) for x in (r.kind, rank)])
    active = known.where(versions[F.col("s.kind")] == F.col("version")).withColumn("s", F.col("s").withField("rank", ranks[F.col("s.kind")]))
    return by_path(paths, cut(gathered(active.select("blob", "s"))))


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op9_secrets(spark, sf_dir) -> DataFrame:
    """The documents in two deliveries over one stored ledger: some half of the ids, then the whole table.

    The second scans only the blobs that the first did not have, and its findings are those of all documents.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = shared_folder(spark, "ledger")
    scan_stored(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), folder)
    findings = scan_stored(docs, folder)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return findings.select(F.col("path").alias("doc_id"), *[count(k) for k in BASE], F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def _kind_sql(rule: Rule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    pieces = f"string_split_regex(text, '{pattern}')"
    return f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind,
      coalesce(list_sum(list_transform(parts[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS start,
      length(whole[i]) AS n, length(grp[i]) AS g, {rule.least} AS least
    FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM (
      SELECT doc_id, {pieces} AS parts, regexp_extract_all(text, '{pattern}') AS whole, regexp_extract_all(text, '{pattern}', {rule.group}) AS grp FROM d))"""


OP9_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(_kind_sql(r, i) for i, r in enumerate(RULES))}),
s AS (SELECT doc_id, rank, kind, CAST(start AS BIGINT) AS start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT) AS span FROM m WHERE g >= least),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY start, rank) FILTER (kind IN ('assign', 'access', 'hex')) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""
