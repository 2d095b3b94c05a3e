"""Secret scan with multipart credential linking.

Base kinds (assign, access, hex) are reported wherever they occur. Weak
candidates are reported only when complementary parts occur within ``SCOPE``
code points of each other in the document:

* account (``user=...``, ``client_id: ...``) next to a secret part,
* secret (a bare base64 run) next to an identifier,
* endpoint (URL or host:port) next to an identifier linked with a secret. Host
  names are of 2 to 9 labels of at most 63 characters, as their format has it.

Identifiers are access and account spans, secret parts are assign, hex and
secret spans. Parts meet in an interval join on (document, bin of SCOPE code
points), so a document with many candidates is dealt over its bins. All pairs
in scope count; the nearest identifier of a secret part only names its credential.

Spans are code points, end exclusive. They come from the matches and the gaps
between them (``regexp_extract_all`` and ``split`` by the same pattern).
DataFrame functions only. Null text is empty: no spans. Repeated rows each
get their result. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, store

#: Fixed patterns (Java regex) and least lengths; base kinds first, in order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    ("assign", ASSIGN, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    ("account", r"""(?i:(user|username|login|account|client_?id|access_?key_?id))["']?\x20?[:=]\x20?["']?([A-Za-z0-9_.@-]{3,})""", 0, 1),
    ("secret", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}={0,2}", 0, 32),
    ("endpoint", r"""https?://[^\x00-\x20"'<>]+|(?<![A-Za-z0-9.-])[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}:[0-9]{2,5}(?![0-9])""", 0, 8),
]
BASE = 3
IDENTIFIERS = ["access", "account"]
SECRETS = ["assign", "hex", "secret"]
SCOPE = 256
NAMES = [k[0] for k in KINDS]


def _found(text: Column, pattern: str, group: int) -> Column:
    """Per match: code points of the gap before it, of it and of its group."""
    p = F.lit(pattern)

    def parts(m: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        checked = F.regexp_extract_all(text, p, F.lit(group)) if group else m
        made = F.arrays_zip(F.transform(F.slice(gaps, 1, F.size(m)), F.char_length).alias("gap"),
                            F.transform(m, F.char_length).alias("len"),
                            F.transform(checked, F.char_length).alias("checked"))
        return F.when(F.size(m) > 0, made)
    return let(F.regexp_extract_all(text, p, F.lit(0)), parts)


def candidates(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the documents without their texts, under a 128-bit key of
    id and text (_k1, _k2); and all base and weak spans per distinct key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = store(df.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("_k1"),
        F.xxhash64("text", F.lit("2"), "doc_id").alias("_k2"),
        *[_found(text, pattern, group).alias(f"_{name}") for name, pattern, group, _ in KINDS]), "secret-matches")
    some = F.coalesce(*[F.col(f"_{n}") for n in NAMES]).isNotNull()
    per_kind = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"_{n}").alias("m")) for i, n in enumerate(NAMES)])
    once = rows.where(some).dropDuplicates(["_k1", "_k2"])
    each = (once.select("_k1", "_k2", F.explode(per_kind).alias("x"))
            .select("_k1", "_k2", "x.kind", F.posexplode("x.m").alias("i", "m")))
    w = Window.partitionBy("_k1", "_k2", "kind").orderBy("i")
    each = each.withColumn("end", F.sum(F.col("m.gap") + F.col("m.len")).over(w).cast("long"))
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    spans = each.where(F.col("m.checked") >= least).select(
        "_k1", "_k2", "kind", (F.col("end") - F.col("m.len")).alias("start"), "end")
    return rows, store(spans, "secret-spans")


def _numbers(names: list[str]) -> list[int]:
    return [NAMES.index(n) for n in names]


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """Interval join: pairs of spans (start, end) and (r_start, r_end) of one
    document with at most SCOPE code points between them."""
    def bins(a: Column, b: Column) -> Column:
        return F.explode(F.sequence(F.floor(a / SCOPE), F.floor(b / SCOPE)))
    a = left.withColumn("_bin", bins(F.col("start"), F.col("end")))
    b = right.select("_k1", "_k2", F.col("kind").alias("r_kind"), F.col("start").alias("r_start"),
                     F.col("end").alias("r_end"),
                     bins(F.greatest(F.lit(0), F.col("start") - SCOPE), F.col("end") + SCOPE).alias("_bin"))
    gap = F.greatest(F.lit(0), F.col("r_start") - F.col("end"), F.col("start") - F.col("r_end"))
    return a.join(b, ["_k1", "_k2", "_bin"]).where(gap <= SCOPE).withColumn("gap", gap).drop("_bin")


def pairs(spans: DataFrame) -> DataFrame:
    """Every secret part (kind, start, end) with every identifier in scope (r_kind, r_start, r_end) and their gap.
    An account or secret span that overlaps its partner does not count; pairs may repeat."""
    ids = spans.where(F.col("kind").isin(_numbers(IDENTIFIERS)))
    secrets = spans.where(F.col("kind").isin(_numbers(SECRETS)))
    apart = (F.col("end") <= F.col("r_start")) | (F.col("r_end") <= F.col("start"))
    return _near(secrets, ids).where(apart)


def linked(spans: DataFrame) -> DataFrame:
    """Credentials: each secret part with its nearest identifier in scope:
    secret_kind, start, end, id_kind, id_start, id_end. One row per secret part
    that has one."""
    best = F.min(F.struct("gap", "r_start", "r_kind", "r_end")).alias("b")
    return pairs(spans).groupBy("_k1", "_k2", F.col("kind").alias("secret_kind"), "start", "end").agg(best).select(
        "_k1", "_k2", "secret_kind", "start", "end", F.col("b.r_kind").alias("id_kind"),
        F.col("b.r_start").alias("id_start"), F.col("b.r_end").alias("id_end"))


def reported_weak(spans: DataFrame) -> DataFrame:
    """The weak spans whose complementary parts occur in scope."""
    keys = ["_k1", "_k2"]
    met = store(pairs(spans), "secret-pairs")
    # all pairs of a secret part have it in common, so that what is in scope of
    # one of them is in scope of the stretch from the first to the last
    links = store(met.groupBy(*keys, "kind", "start", "end").agg(
        F.least("start", F.min("r_start")).alias("first"), F.greatest("end", F.max("r_end")).alias("last")), "secret-links")
    secret = links.where(F.col("kind") >= BASE).select(*keys, "kind", "start", "end")
    account = met.where(F.col("r_kind") >= BASE).select(
        *keys, F.col("r_kind").alias("kind"), F.col("r_start").alias("start"), F.col("r_end").alias("end"))
    whole = links.select(*keys, F.lit(0).alias("kind"), F.col("first").alias("start"), F.col("last").alias("end"))
    ends = _near(spans.where(F.col("kind") == NAMES.index("endpoint")), whole)
    return (secret.unionByName(account).unionByName(ends.select(*keys, "kind", "start", "end"))
            .select(*keys, "kind", "start", "end").distinct())


def scan(df: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 and spans
    (kind:start:end by start, then kind as listed, comma-joined)."""
    rows, spans = candidates(df)
    base = spans.where(F.col("kind") < BASE)
    every = base.unionByName(reported_weak(spans))
    per_doc = every.groupBy("_k1", "_k2").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"),
        *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{NAMES[i]}") for i in range(BASE)])
    names = F.array(*[F.lit(n) for n in NAMES])
    listed = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(
        ":", names[x["kind"]], x["start"], x["end"])), ",")
    out = rows.select("doc_id", "_k1", "_k2").join(per_doc, ["_k1", "_k2"], "left")
    s = F.coalesce(F.col("s"), F.array().cast(per_doc.schema["s"].dataType))
    return out.select(
        "doc_id", *[F.coalesce(f"n_{NAMES[i]}", F.lit(0)).cast("long").alias(f"n_{NAMES[i]}") for i in range(BASE)],
        F.sha2(listed(F.filter(s, lambda x: x["kind"] < BASE)).cast("binary"), 256).alias("base_sha256"),
        listed(s).alias("spans"))
