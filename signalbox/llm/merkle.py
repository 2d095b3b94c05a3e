"""Merkle manifest of a dataset as a SHA midstate tree.

Each document is a leaf, the SHA-256 of its fields. Per source the leaves
ascend by doc_id and every ``FANOUT`` consecutive nodes become the hash of
their digests, until one remains: the source's subroot. The subroots, by
source, become the root likewise. A parent is hashed once and keeps, before
each child slot, a *copy of the hash state*: to fold another digest into a
slot, the copy of that slot goes on with the replacement and the siblings to
its right; what stands left of it is never hashed again. The leaf of a changed
text resumes from the state before the text in the same way.

Spark holds the tree in rows of ``BLOCK`` = FANOUT**3 consecutive nodes (three
levels a round), so a task sees blocks of a bounded size whatever the size of
a source: upwards each block gives one node of the next round, downwards each
block gets the siblings of its ancestors (two strings a level). Positions come
from running totals over cells of ids, so a hot source is many tasks.

Null texts and other nulls are hashed as ``-``. Repeated ids come by their
leaf, repeated rows are leaves of their own, null ids come last. A null source
is a source of its own and comes first; sources compare as UTF-8 bytes. Empty
table: no rows. Very long texts are hashed in the batch they come in. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import assign_ids
from .common import order_key, running_total, store

FANOUT = 16
LEVELS = 3
BLOCK = FANOUT ** LEVELS
_BITS = BLOCK.bit_length() - 1

#: Lower-cases A-Z alone.
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_SIDE = pa.struct([("left", pa.string()), ("right", pa.string())])
_PATH = "array<struct<left:string,right:string>>"


def field(value: object) -> bytes:
    """A field as it is hashed: ``-`` or UTF-8 byte count, colon, value."""
    if value is None:
        return b"-"
    b = str(value).encode("utf-8", "surrogatepass")
    return b"%d:%b" % (len(b), b)


def _leaves(change: Callable[[str], str]):
    """(leaf, the leaf after ``change`` of the text or null) of chosen rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf, changed = [], []
            columns = [b.column(c).to_pylist() for c in ("doc_id", "source", "lang", "n_chars", "text", "chosen")]
            for doc_id, source, lang, n_chars, text, chosen in zip(*columns):
                state = hashlib.sha256(field(doc_id) + field(source) + field(lang) + field(n_chars))
                before_text = state.copy()
                state.update(field(text))
                leaf.append(state.hexdigest())
                other = change(text) if chosen and text is not None else text
                if other != text:
                    before_text.update(field(other))
                    changed.append(before_text.hexdigest())
                else:
                    changed.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), pa.array(leaf, pa.string()), pa.array(changed, pa.string())],
                ["doc_id", "source", "leaf", "changed"])
    return run


class Node:
    """A parent: its digest, and the hash state before each child slot."""

    def __init__(self, children: list[str]):
        state, self.states = hashlib.sha256(), []
        self.children = [c.encode() for c in children]
        for c in self.children:
            self.states.append(state.copy())
            state.update(c)
        self.digest = state.hexdigest()

    def sides(self, slot: int) -> tuple[bytes, bytes]:
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1:])

    def fold(self, slot: int, replacement: str) -> str:
        """The digest with another child at ``slot``."""
        state = self.states[slot].copy()
        state.update(replacement.encode())
        state.update(self.sides(slot)[1])
        return state.hexdigest()


def grow(digests: list[str], alone: bool) -> list[list[Node]]:
    """The levels above the nodes of a block: ``LEVELS`` of them, or, where the
    block holds all nodes, as many as leave one node."""
    levels: list[list[Node]] = []
    while len(levels) < LEVELS and not (alone and len(digests) == 1):
        levels.append([Node(digests[i:i + FANOUT]) for i in range(0, len(digests), FANOUT)])
        digests = [n.digest for n in levels[-1]]
    return levels


def _alone(block: int, n: int) -> bool:
    """A first block that is not full is the whole tree of its group; a full
    one gives a single node in all its levels either way."""
    return block == 0 and n < BLOCK


def _raised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        top = []
        for block, items in zip(b.column("block").to_pylist(), b.column("items")):
            digests = [x["digest"] for x in items.as_py()]
            levels = grow(digests, _alone(block, len(digests)))
            top.append(levels[-1][0].digest if levels else digests[0])
        yield pa.RecordBatch.from_arrays(
            [b.column("has"), b.column("src"), b.column("block"), pa.array(top, pa.string())], ["has", "src", "idx", "digest"])


def _paths(levels: list[list[Node]], i: int) -> list[dict[str, str]]:
    out = []
    for level in levels:
        left, right = level[i // FANOUT].sides(i % FANOUT)
        out.append({"left": left.decode(), "right": right.decode()})
        i //= FANOUT
    return out


def _lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of every node of a block: its siblings up to the root."""
    for b in batches:
        has, src, idx, path = [], [], [], []
        for h, s, block, items, above in zip(*[b.column(c) for c in ("has", "src", "block", "items", "path")]):
            items, above = items.as_py(), above.as_py()
            levels = grow([x["digest"] for x in items], _alone(block.as_py(), len(items)))
            for i, x in enumerate(items):
                has.append(h.as_py())
                src.append(s.as_py())
                idx.append(x["idx"])
                path.append(_paths(levels, i) + above)
        yield pa.RecordBatch.from_arrays(
            [pa.array(has, pa.int32()), pa.array(src, pa.string()), pa.array(idx, pa.int64()),
             pa.array(path, pa.list_(_SIDE))], ["has", "src", "idx", "path"])


def _proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per leaf of a block: proof, and the root with its changed leaf."""
    for b in batches:
        out: dict[str, list] = {k: [] for k in ("has", "src", "subroot", "doc_id", "leaf", "proof_sha256", "folded_root")}
        for h, s, subroot, block, items, above in zip(*[b.column(c) for c in ("has", "src", "subroot", "block", "items", "path")]):
            items, above, h, s, subroot = items.as_py(), above.as_py(), h.as_py(), s.as_py(), subroot.as_py()
            levels = grow([x["digest"] for x in items], _alone(block.as_py(), len(items)))
            states = [hashlib.sha256(p["left"].encode()) for p in above]
            rights = [p["right"].encode() for p in above]
            siblings = "".join(p["left"] + p["right"] for p in above).encode()
            for i, x in enumerate(items):
                proof, at = hashlib.sha256(), i
                digest = x["changed"] or x["digest"]
                for level in levels:
                    node, slot = level[at // FANOUT], at % FANOUT
                    for side in node.sides(slot):
                        proof.update(side)
                    digest = node.fold(slot, digest)
                    at //= FANOUT
                proof.update(siblings)
                for state, right in zip(states, rights):
                    state = state.copy()
                    state.update(digest.encode())
                    state.update(right)
                    digest = state.hexdigest()
                for k, v in zip(out, (h, s, subroot, x["doc_id"], x["digest"], proof.hexdigest(), digest)):
                    out[k].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int32() if k == "has" else pa.int64() if k == "doc_id" else pa.string()) for k, v in out.items()], list(out))


def _blocks(nodes: DataFrame, *more: str) -> DataFrame:
    """Rows of ``BLOCK`` consecutive nodes of a group, in order."""
    item = F.struct("idx", "digest", *more)
    return nodes.groupBy("has", "src", F.shiftright("idx", _BITS).alias("block")).agg(
        F.sort_array(F.collect_list(item)).alias("items"))


def _up(nodes: DataFrame, *more: str) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks, from the nodes up, and the one node of each group."""
    rounds = []
    while True:
        rounds.append(store(_blocks(nodes, *more), "merkle-blocks"))
        more = ()
        nodes = store(rounds[-1].mapInArrow(_raised, "has int, src string, idx long, digest string"), "merkle-nodes")
        if nodes.where("idx > 0").isEmpty():
            return rounds, nodes


def _down(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths (has, src, idx, path) of the nodes of the lowest round, from the
    paths of the groups' own nodes."""
    for blocks in reversed(rounds):
        paths = store(_beside(blocks, paths).mapInArrow(_lowered, f"has int, src string, idx long, path {_PATH}"), "merkle-paths")
    return paths


def _beside(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    return blocks.join(paths.withColumnRenamed("idx", "block"), ["has", "src", "block"])


def chosen_by_crc(doc_id: Column) -> Column:
    """True where 5 divides the unsigned crc32 of the decimal id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def manifest(df: DataFrame, chosen: Column, change: Callable[[str], str]) -> DataFrame:
    """Per document: doc_id, source, leaf, subroot, root, proof_sha256, and
    folded_root, the root that its leaf and the siblings give after ``change``
    of the text of ``chosen`` rows."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                     F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
                     F.col("text").cast("string").alias("text"), chosen.alias("chosen"))
    leaves = rows.mapInArrow(_leaves(change), "doc_id long, source string, leaf string, changed string")
    leaves = store(leaves.select(
        F.col("source").isNotNull().cast("int").alias("has"), F.coalesce("source", F.lit("")).alias("src"), "doc_id",
        F.col("leaf").alias("digest"), "changed", order_key("doc_id", F.col("leaf")).alias("_ord"),
        F.lit(1).cast("long").alias("_one")), "merkle-leaves")
    placed = running_total(leaves, ["has", "src"], "_ord", ["digest"], "_one", "idx")
    rounds, subroots = _up(placed, "doc_id", "changed")
    subroots = subroots.select("has", "src", F.col("digest").alias("subroot"))
    ranked = store(assign_ids(subroots, ["has", "src"], "rank"), "merkle-sources")
    every = ranked.select(F.lit(0).alias("has"), F.lit("").alias("src"), (F.col("rank") - 1).alias("idx"), F.col("subroot").alias("digest"))
    tops, root = _up(every)
    above = _down(tops, root.select("has", "src", "idx", F.expr(f"cast(array() as {_PATH})").alias("path")))
    paths = ranked.join(above.select((F.col("idx") + 1).alias("rank"), "path"), "rank").select(
        "has", "src", F.lit(0).cast("long").alias("idx"), "path")
    paths = _down(rounds[1:], paths).join(ranked.select("has", "src", "subroot"), ["has", "src"])
    proved = _beside(rounds[0], paths).mapInArrow(
        _proved, "has int, src string, subroot string, doc_id long, leaf string, proof_sha256 string, folded_root string")
    top = root.first()  # one row
    return proved.select(
        "doc_id", F.when(F.col("has") == 1, F.col("src")).alias("source"), "leaf", "subroot",
        F.lit(top["digest"] if top else None).cast("string").alias("root"), "proof_sha256", "folded_root")


def lower_ascii(text: str) -> str:
    return text.translate(LOWER)


def manifest_report(df: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    out = manifest(df, chosen_by_crc(F.col("doc_id")), lower_ascii)
    return out.drop("source").withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels that the SQL unrolls within a source and above the sources: enough for
#: 16**6 documents a source and 16**3 sources.
SQL_LEVELS, SQL_TOP_LEVELS = 6, 3


def oracle() -> str:
    """DuckDB SQL for ``manifest_report``: every level of the tree as a table,
    every fold by hashing the whole run anew."""
    def value(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    head = " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars"))
    bit = "list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda a, i: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b))"
    crc = ("xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)), "
           f"lambda c, b: {bit}, CAST(4294967295 AS BIGINT)), 4294967295)")

    def levels(name: str, n: int) -> str:
        """name_k: the nodes of level k; name_run_k: their runs of 16."""
        out = []
        for k in range(n):
            out.append(f"""
{name}_run_{k} AS (
  SELECT grp, idx // {FANOUT} AS run, list(h ORDER BY idx) AS hs, any_value(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}_{k}) GROUP BY grp, idx // {FANOUT}),
{name}_{k + 1} AS (
  SELECT grp, run AS idx, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}_run_{k})""")
        return ",".join(out)

    def folds(source: str, name: str, at: str, n: int, to: str) -> str:
        """Through the runs of all levels: the fold and the siblings so far."""
        out, last = [], source
        for k in range(n):
            step = f"{to}_{k}"
            left = f"array_to_string(hs[1:{at} % {FANOUT}], '')"
            right = f"array_to_string(hs[{at} % {FANOUT} + 2:], '')"
            out.append(f"""
{step} AS (
  SELECT x.* REPLACE (CASE WHEN n = 1 THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
                      CASE WHEN n = 1 THEN siblings ELSE siblings || {left} || {right} END AS siblings, {at} // {FANOUT} AS {at})
  FROM {last} x JOIN {name}_run_{k} r ON r.grp = x.{'src' if name == 's' else 'one'} AND r.run = x.{at} // {FANOUT})""")
            last = step
        return ",".join(out)
    return f"""
WITH leaves AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS src, sha256({head} || {value('text')}) AS h,
         sha256({head} || {value("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS low,
         coalesce({crc} % 5 = 0, FALSE) AS chosen FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS LAST, h) - 1 AS i FROM leaves),
s_0 AS (SELECT src AS grp, i AS idx, h FROM placed),{levels("s", SQL_LEVELS)},
subroots AS (SELECT grp AS src, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS j FROM s_{SQL_LEVELS}),
t_0 AS (SELECT 1 AS grp, j AS idx, subroot AS h FROM subroots),{levels("t", SQL_TOP_LEVELS)},
start AS (
  SELECT doc_id, src, h AS leaf, i, j, 1 AS one, subroot, CASE WHEN chosen THEN low ELSE h END AS cur, '' AS siblings
  FROM placed JOIN subroots USING (src)),{folds("start", "s", "i", SQL_LEVELS, "up")},{folds(f"up_{SQL_LEVELS - 1}", "t", "j", SQL_TOP_LEVELS, "top")}
SELECT doc_id, leaf, subroot, t.h AS root, sha256(siblings) AS proof_sha256, cur AS folded_root, cur = t.h AS verified
FROM top_{SQL_TOP_LEVELS - 1}, t_{SQL_TOP_LEVELS} t
"""
