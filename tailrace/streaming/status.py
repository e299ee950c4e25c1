"""Counters of status logs as streaming state."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailrace.operators.status import counter_changes

_VALUES = ("int_add", "int_set", "double_add", "double_set")
# Bits of milliseconds (4 seconds, then 4.7 hours), and into how many shares the counters are dealt.
_LEVELS = ((12, 16), (24, 1024))
_STATE = "int_value bigint, double_value double"


def stream_status_counters(log: DataFrame) -> DataFrame:
    """Current ``ivalue`` and ``dvalue`` of every counter that a batch changes (update mode).

    Entries of a batch apply in note order, ties as in ``fold_status_counters``; batches in the order they arrive. They
    are folded per stretch of time first, so the state function sees one row per counter and 4.7 hours of a batch.
    """
    changes = folded_in_blocks(counter_changes(log))
    # pandas would turn whole numbers with gaps into doubles, so gaps travel as flags.
    for name in _VALUES:
        zero = F.lit(0).cast(changes.schema[name].dataType)
        changes = changes.withColumns({f"has_{name}": F.col(name).isNotNull(), name: F.coalesce(name, zero)})
    keyed = changes.groupBy("id", "key")
    schema = "id int, key string, ivalue bigint, dvalue double"
    return keyed.applyInPandasWithState(_apply_changes, schema, _STATE, "update", "NoTimeout")


def folded_in_blocks(changes: DataFrame) -> DataFrame:
    """One change per counter and stretch of time that has the effect of all of its changes in order.

    Streams take no aggregate here. A group is what a share of the counters got in 4 seconds, then 4,096 rows of each of
    a smaller share; counters are folded side by side, since a group for each would cost more than its rows.
    """
    schema = changes.schema
    for bits, shares in _LEVELS:
        share = F.pmod(F.xxhash64("id", "key"), F.lit(shares)).alias("share")
        groups = changes.groupBy(share, F.shiftright(F.col("time").cast("bigint"), bits).alias("block"))
        changes = groups.applyInArrow(_as_one_each, schema)
    return changes


def _as_one_each(changes: pa.Table) -> pa.Table:
    """One row for every counter of a table of changes."""
    if changes.num_rows == 1:
        return changes
    ids, keys = (changes.column(c).combine_chunks().dictionary_encode("encode") for c in ("id", "key"))
    counter = ids.indices.to_numpy().astype(np.int64) * len(keys.dictionary) + keys.indices.to_numpy()
    time, pos = (changes.column(c).to_numpy() for c in ("time", "pos"))
    order = np.lexsort((pos, time, counter))
    changes, counter, time, pos = changes.take(pa.array(order)), counter[order], time[order], pos[order]
    place, n = np.arange(len(order)), len(order)
    starts = np.append(True, np.diff(counter) != 0)
    moments = starts | np.append(True, (time[1:] != time[:-1]) | (pos[1:] != pos[:-1]))
    moment = np.maximum.accumulate(np.where(moments, place, 0))
    begin = np.flatnonzero(starts)
    end = np.append(begin[1:], n)
    folded = changes.take(pa.array(end - 1))
    for kind, total in (("int", _int_sums), ("double", _double_sums)):
        sets, adds = (changes.column(f"{kind}_{c}").combine_chunks() for c in ("set", "add"))
        last = np.maximum.reduceat(np.where(sets.is_valid(), place, -1), begin)
        # What was set last counts, with all that stands at the same time and place.
        first = np.where(last < 0, begin, moment[last])
        value = sets.take(pa.array(np.where(last < 0, end - 1, last)))
        several = np.flatnonzero((last >= 0) & (first < last)).tolist()
        if several:
            value = value.to_pylist()
            for i in several:
                value[i] = max(sets.slice(int(first[i]), int(last[i] + 1 - first[i])).drop_null().to_pylist())
            value = pa.array(value, sets.type)
        counts = adds.is_valid().to_numpy(zero_copy_only=False) & (place >= np.repeat(first, end - begin))
        added = pa.array(total(adds.fill_null(0).to_numpy(), counts, begin), adds.type, mask=~np.logical_or.reduceat(counts, begin))
        for name, column in ((f"{kind}_set", value), (f"{kind}_add", added)):
            folded = folded.set_column(folded.schema.get_field_index(name), folded.schema.field(name), column)
    return folded


def _int_sums(added: np.ndarray, counts: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return np.add.reduceat(np.where(counts, added, 0), begin)


def _double_sums(added: np.ndarray, counts: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Correctly rounded sums of what counts from each of ``begin`` on."""
    before = np.append(0, np.cumsum(counts))
    first, end = before[begin], before[np.append(begin[1:], len(added))]
    added = added[counts]
    sums = np.zeros(len(begin))
    single = end - first == 1
    sums[single] = added[first[single]]
    for i in np.flatnonzero(end - first > 1).tolist():
        sums[i] = math.fsum(added[first[i] : end[i]].tolist())
    return sums


def _apply_changes(key, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    chunks = list(chunks)
    changes = chunks[0] if len(chunks) == 1 else pd.concat(chunks)
    if len(changes) > 1:
        changes = changes.sort_values(["time", "pos"], kind="stable")
    ints, doubles = state.get if state.exists else (None, None)
    ints = _folded(changes, "int", ints, lambda added: int(added.sum()))
    doubles = _folded(changes, "double", doubles, lambda added: math.fsum(added))
    state.update((ints, doubles))
    yield pd.DataFrame(
        {
            "id": pd.Series([key[0]], dtype="int32"),
            "key": [key[1]],
            "ivalue": pd.Series([ints], dtype="Int64"),
            "dvalue": pd.Series([doubles], dtype="float64"),
        }
    )


def _folded(changes: pd.DataFrame, kind: str, value, total):
    sets = changes[f"has_{kind}_set"].to_numpy().nonzero()[0]
    counts, adds = changes[f"has_{kind}_add"].to_numpy(), changes[f"{kind}_add"].to_numpy()
    if len(sets):
        value = changes[f"{kind}_set"].to_numpy()[sets[-1]].item()
        counts, adds = counts[sets[-1] :], adds[sets[-1] :]
    if counts.any():
        value = (value or 0) + total(adds[counts])
    return value
