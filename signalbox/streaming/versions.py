"""A version passes once over the life of the stream, by keyed state.

A stateful operator keyed by the bucket of the incident version keeps, in the
RocksDB state store, the digests (16 bytes each) of the versions of that bucket:
an epoch reads the buckets of the versions it holds and nothing else. Python is
called once a bucket and not once a version, as a call costs about a
millisecond; ``BUCKETS`` of them keep a bucket's state small (ten million
versions: some 600 in each). Messages whose incident would not be stored
(broken, without routes, or without a required value) carry no version to
remember and pass every time they come.

Of several complete messages of one version in an epoch the first by
``MESSAGE_ORDER``, then by its parsed fields, passes, so a replayed epoch gives
the same messages. A message goes to its bucket as it was parsed; the text goes
along with those alone that are quarantined with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import incidents as I
from ..sources.xml_docs import pack_message, parse_incidents

#: Groups that the versions are dealt to, and bytes kept of a version; fixed for the life of a stream.
BUCKETS = 1 << 14
DIGEST = 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank() -> Column:
    """One text that sorts as ``MESSAGE_ORDER`` does: nulls first, and after each
    value the least character, which XML does not allow in one."""
    def part(name: str) -> Column:
        c = F.col(name)
        if name == "incident_priority":
            c = F.lpad((c.cast("long") + (1 << 31)).cast("string"), 10, "0")
        return F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c.cast("string"), F.lit("\x00")))
    return F.concat(*[part(c) for c in I.MESSAGE_ORDER])


def _keyed(messages: DataFrame) -> DataFrame:
    parsed = parse_incidents(messages)
    details = I.incident_details(parsed.withColumns({"text": F.col("raw"), "parsed": pack_message()}))
    bad = I.quarantine_reason().isNotNull()
    complete = ~bad & ~I.incomplete()
    # a row that is not suppressed has no digest and goes by its own text: no hot group of all of them
    by = F.when(complete, F.concat(F.lit("v"), "version")).otherwise(F.coalesce("text", F.lit("")))
    digest = F.when(complete, F.unhex(F.substring(F.sha2("version", 256), 1, 2 * DIGEST)))
    return details.select(F.pmod(F.xxhash64(by), F.lit(BUCKETS)).cast("int").alias("_bucket"), digest.alias("digest"),
                          "message_key", F.when(bad, F.col("text")).alias("value"),
                          F.when(complete, _rank()).alias("rank"), "parsed")


def _first(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Of one bucket: the rows without a digest, and the first of each digest that the state has not."""
    held = bytes(state.get[0]) if state.exists else b""
    seen = {held[i:i + DIGEST] for i in range(0, len(held), DIGEST)}
    best: dict[bytes, tuple] = {}
    for rows in frames:
        named = rows["digest"].notna()
        if not named.all():
            yield rows.loc[~named, ["message_key", "value", "parsed"]]
            rows = rows[named]
        for d, r, p, m in zip(*(rows[c].array for c in ("digest", "rank", "parsed", "message_key"))):
            d = bytes(d)
            if d not in seen and (d not in best or (r, p) < best[d][:2]):
                best[d] = (r, p, m)
    if best:
        state.update((held + b"".join(sorted(best)),))
        yield pd.DataFrame({"message_key": [b[2] for b in best.values()], "value": None, "parsed": [b[1] for b in best.values()]})


def first_versions(messages: DataFrame) -> DataFrame:
    """A stream of (message_key, value, parsed) without the versions that it had
    before; ``parsed`` is the message as ``pack_message`` has it, so that what
    comes after need not parse the text again, and ``value`` the text of one that
    is to be quarantined, else null."""
    return _keyed(messages).groupBy("_bucket").applyInPandasWithState(
        _first, "message_key string, value string, parsed string", "seen binary", "append", GroupStateTimeout.NoTimeout)
