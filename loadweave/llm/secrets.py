"""Secret scans with multipart credential linking, in DataFrame operations only.

Base spans are assignments of passwords and the like, access identifiers, and long hexadecimal runs. Weak candidates are
other runs of exactly 40 key characters ("secret"; up to two of them '=' at the end, none before) and web addresses
("endpoint"); alone they mean little. They are
interval-joined with access identifiers of the same text: a secret within SCOPE code points of an access identifier is
reported, and an endpoint within SCOPE of an access identifier that has such a secret too. The join hashes scopes of
SCOPE code points, each of which holds a bounded number of parts, so its rows grow in proportion to the text. A part is in
all scopes that it reaches into, and a pair comes from the first scope that both are in.

Spark gives a match's text but not its place; the places follow from adding up the lengths of matches and of the stretches
between them. Lengths count code points.

Cases: a null text is empty and has no spans; a null doc_id is kept; repeated rows repeat; rows that share a doc_id but not
a text are told apart by a hash of the text; an empty table gives no rows; further columns are kept by `redact`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, settled, sized, table

# The base patterns, with letters in either case spelt out, and the weak ones.
_EITHER = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
ASSIGN = f"(?:{_EITHER})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Runs are maximal, so asking for the least length in the pattern finds the same spans as dropping shorter runs.
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
#: '=' belongs to a key as padding only, so that NAME=<key> is a name and a key.
SECRET = "(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{38}(?:[A-Za-z0-9/+]{2}|[A-Za-z0-9/+]=|==)(?![A-Za-z0-9/+=])"
ENDPOINT = "https?://[A-Za-z0-9._~:/?#@!$&()*+;=%-]+"
KINDS = ("assign", "access", "hex", "secret", "endpoint")
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, SECRET, ENDPOINT), strict=True))
#: The SQL counterpart's engine has no look-arounds. It takes runs with '=' anywhere; a key can only be a run's last 40 characters.
SQL_PATTERNS = PATTERNS | {"secret": "[A-Za-z0-9/+=]{40,}"}
SQL_KEY = "[A-Za-z0-9/+]{38}([A-Za-z0-9/+]{2}|[A-Za-z0-9/+]=|==)"
#: Code points between the ends of two parts of one credential, at most.
SCOPE = 200
#: Least length of an assigned value; exact length of a weak secret.
VALUE, KEY = 8, 40


def _key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("hash"), F.length(text).alias("size"))


def base_and_weak(docs: DataFrame) -> DataFrame:
    """(doc_id, key, kind, order, start, end) of all base spans and weak candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = []
    for kind, pattern in PATTERNS.items():
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if kind == "assign" else F.array().cast("array<string>")
        found.append(F.when(text.rlike(pattern), F.struct(F.lit(kind).alias("kind"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), F.split(text, pattern, -1).alias("gap"), value.alias("value"))))
    rows = docs.select("doc_id", _key(text).alias("key"), F.filter(F.array(*found), lambda x: x.isNotNull()).alias("found")).where(F.size("found") > 0)
    # Rows repeated in full give the same spans; they count once here.
    each = rows.groupBy("doc_id", "key").agg(F.first("found").alias("found")).select("doc_id", "key", F.explode("found").alias("f"))
    each = each.select("doc_id", "key", F.col("f.kind").alias("kind"), F.posexplode(F.arrays_zip("f.match", "f.gap", "f.value")).alias("n", "x")).where(F.col("x.match").isNotNull())
    w = Window.partitionBy("doc_id", "key", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("x.match")
    placed = each.withColumn("end", F.sum(F.length("x.gap") + size).over(w)).withColumn("start", F.col("end") - size)
    fits = (
        F.when(F.col("kind") == "assign", F.length("x.value") >= VALUE)
        .when(F.col("kind") == "secret", (size == KEY) & ~F.col("x.match").rlike("^[0-9a-f]*$"))
        .otherwise(True)
    )
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("order")
    return placed.where(fits).select("doc_id", "key", "kind", order, "start", "end")


def link(spans: DataFrame) -> DataFrame:
    """The weak candidates of spans that stand near their complements."""
    of = lambda kind: spans.where(F.col("kind") == kind)
    scope = lambda c, by: F.floor((F.col(c) + by) / SCOPE)
    scopes = lambda by: F.explode(F.sequence(scope("start", -by), scope("end", by)))
    access = of("access").select(F.col("doc_id").alias("a_doc"), F.col("key").alias("a_key"), F.col("start").alias("a_start"), F.col("end").alias("a_end"), scope("start", -SCOPE).alias("a_first"), scopes(SCOPE).alias("a_scope"))
    weak = spans.where(F.col("kind").isin("secret", "endpoint")).withColumn("first", scope("start", 0)).withColumn("scope", scopes(0))
    near = weak.join(
        access,
        F.col("doc_id").eqNullSafe(F.col("a_doc")) & (F.col("key") == F.col("a_key")) & (F.col("scope") == F.col("a_scope")) & (F.col("scope") == F.greatest("first", "a_first")) & (F.col("start") <= F.col("a_end") + SCOPE) & (F.col("end") >= F.col("a_start") - SCOPE),
    )
    # Of each access identifier: is there a secret near it? Endpoints count only then.
    by_access = Window.partitionBy("a_doc", "a_key", "a_start")
    whole = near.withColumn("secrets", F.max((F.col("kind") == "secret").cast("int")).over(by_access)).where(F.col("secrets") == 1)
    return whole.select("doc_id", "key", "kind", "order", "start", "end").distinct()


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, key, and `spans`, an array of (start, order, kind, end) by start and kind."""
    spans = base_and_weak(docs)
    base = spans.where(F.col("order") <= 3)
    every = base.unionByName(link(spans))
    of_text = every.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", "order", "kind", "end"))).alias("spans"))
    of_text = of_text.select(F.col("doc_id").alias("s_doc"), F.col("key").alias("s_key"), "spans")
    rows = docs.select("doc_id", _key(F.coalesce(F.col("text"), F.lit(""))).alias("key"))
    none = F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>")
    return rows.join(of_text, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("key") == F.col("s_key")), "left").select("doc_id", "key", F.coalesce("spans", none).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every base span's secret replaced: assigned values, access identifiers, hexadecimal runs; n_chars, if there, is counted anew.

    Weak candidates that linking reports are replaced too, wherever their text stands in the document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key, weak, of_doc, of_key, new = fresh(docs, "key", "weak", "of_doc", "of_key", "new")
    linked = link(base_and_weak(docs)).groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "end")).alias(weak))
    linked = settled(linked.select(F.col("doc_id").alias(of_doc), F.col("key").alias(of_key), weak))
    rows = docs.withColumn(key, _key(text)).join(sized(linked), F.col("doc_id").eqNullSafe(F.col(of_doc)) & (F.col(key) == F.col(of_key)), "left")
    # Longest first: an address is replaced as a whole before a key that is part of it.
    words = F.array_distinct(F.transform(F.coalesce(F.col(weak), F.array().cast("array<struct<start:bigint,end:bigint>>")), lambda x: F.substring(text, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))))
    words = F.array_sort(words, lambda a, b: F.length(b) - F.length(a))
    clean = F.aggregate(words, text, lambda t, w: F.replace(t, w, F.lit(mark)))
    named = f"((?:{_EITHER})[\"']?\\x20*[:=]\\x20*[\"']?)[A-Za-z0-9+/_.=-]{{{VALUE},}}"
    for pattern, by in ((named, "$1" + mark), (ACCESS, mark), (HEX, mark)):
        clean = F.regexp_replace(clean, pattern, by)
    out = rows.withColumn(new, F.when(F.col("text").isNotNull(), clean))
    changed = ~F.col(new).eqNullSafe(F.col("text"))
    counted = lambda c, t: F.when(changed, F.length(new)).otherwise(F.col(c)).cast(t).alias(c)
    columns = [counted(c, t) if c == "n_chars" else F.col(new).alias("text") if c == "text" else F.col(f"`{c}`") for c, t in docs.dtypes]
    return out.select(*columns)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["order"] <= 3)
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _sql_spans(kind: str, order: int) -> str:
    pattern = SQL_PATTERNS[kind].replace("'", "''")
    value = f"regexp_extract_all(t, '{pattern}', 1)" if kind == "assign" else "NULL::VARCHAR[]"
    keep = {"assign": f"length(v[i]) >= {VALUE}", "secret": f"regexp_full_match(right(m[i], {KEY}), '{SQL_KEY}') AND (length(m[i]) = {KEY} OR m[i][-{KEY + 1}] = '=') AND NOT regexp_full_match(right(m[i], {KEY}), '[0-9a-f]*')"}.get(kind, "TRUE")
    size = KEY if kind == "secret" else "length(m[i])"
    return f"""SELECT r, '{kind}' AS kind, {order} AS ord, e - {size} AS s, e FROM (
      SELECT r, m, v, i, coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0) AS e FROM (
        SELECT r, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
          SELECT r, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g, {value} AS v FROM docs WHERE regexp_matches(t, '{pattern}')))) WHERE {keep}"""


ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS MATERIALIZED ({' UNION ALL '.join(_sql_spans(kind, k + 1) for k, kind in enumerate(KINDS))}),
near AS (SELECT w.*, a.s AS a FROM found w JOIN found a ON w.r = a.r AND a.kind = 'access' AND w.kind IN ('secret', 'endpoint') AND w.s <= a.e + {SCOPE} AND w.e >= a.s - {SCOPE}),
linked AS (SELECT DISTINCT r, kind, ord, s, e FROM near n WHERE EXISTS (SELECT 1 FROM near o WHERE o.r = n.r AND o.a = n.a AND o.kind = 'secret')),
every AS (SELECT * FROM found WHERE ord <= 3 UNION ALL SELECT * FROM linked),
said AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, ord) FILTER (ord <= 3) AS base, string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, ord) AS spans FROM every GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN said USING (r)
"""

QUERIES = {"op10_secrets": op10_secrets}
ORACLES = {"op10_secrets": ORACLE}
