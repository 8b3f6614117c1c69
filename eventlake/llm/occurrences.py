"""Which keys occur twice: occurrences of one key meet in one bucket, repeats within a task's buffer are settled there.

An occurrence is a 96-bit key (``a``, ``b``) at a place of a row. A key that a
buffer holds several times is sent once, marked as known, and its occurrences
travel as finished spans, so a key that a third of all rows hold costs a row
per buffer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import U64, mix

ROUTED = (
    "bucket int, a binary, b binary, doc binary, tag binary, at binary, kind binary, "
    "s_doc binary, s_tag binary, s_at binary, s_size binary, s_null binary"
)
ROUTED_NAMES = [x.split()[0] for x in ROUTED.split(", ")]


class Buffer:
    """Occurrences of one task, settled and sent in parts of bounded size."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.n = buckets, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.n += len(columns[0])

    def flush(self) -> pa.RecordBatch | None:
        if not self.n:
            return None
        a, b, doc, tag, at, null, bucket = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.n = [], 0
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        first = np.concatenate([[True], ~same])
        group = np.cumsum(first) - 1
        count = np.bincount(group)
        known = np.empty(len(a), bool)  # repeated within this buffer
        known[order] = count[group] > 1
        lead = np.empty(len(a), bool)
        lead[order] = first
        send = lead | ~known
        kind = known.astype(np.int8)  # 1: known to repeat, sent only to tell the others
        out = {k: [] for k in ROUTED_NAMES}
        pick = np.flatnonzero(send)
        pick = pick[np.argsort(bucket[pick], kind="stable")]
        edges = np.flatnonzero(np.diff(bucket[pick], prepend=-1))
        for lo, hi in zip(edges, np.append(edges[1:], len(pick)), strict=True):
            i = pick[lo:hi]
            row = [int(bucket[i[0]]), a[i], b[i], doc[i], tag[i], at[i], kind[i] | (null[i] << 1)]
            for k, v in zip(ROUTED_NAMES, row + [b""] * 5, strict=True):
                out[k].append(v.tobytes() if isinstance(v, np.ndarray) else v)
        # settled windows travel as spans: neighbours in one row are one span
        i = np.flatnonzero(known)
        if len(i):
            joined = (np.diff(at[i]) == 1) & (np.diff(doc[i]) == 0) & (np.diff(tag[i]) == 0)
            starts = np.flatnonzero(np.concatenate([[True], ~joined]))
            sizes = np.diff(np.append(starts, len(i))).astype(np.int32)
            s = i[starts]
            spread = mix(doc[s[:1]].astype(U64) ^ mix(tag[s[:1]].astype(U64)))[0]  # any bucket will do; not the hot key's
            row = [int(spread % U64(self.buckets)), b"", b"", b"", b"", b"", b"", doc[s], tag[s], at[s], sizes, null[s]]
            for k, v in zip(ROUTED_NAMES, row, strict=True):
                out[k].append(v.tobytes() if isinstance(v, np.ndarray) else v)
        return pa.RecordBatch.from_arrays(
            [pa.array(out[k], pa.int32() if k == "bucket" else pa.binary()) for k in ROUTED_NAMES],
            names=ROUTED_NAMES,
        )


def _span_batch(doc, tag, null, at, size) -> pa.Table:
    return pa.table({
        "doc": pa.array(doc, pa.int64()), "tag": pa.array(tag, pa.int64()),
        "null_id": pa.array(null.astype(bool)), "at": pa.array(at, pa.int32()), "size": pa.array(size, pa.int32()),
    })


def exact(group: pa.Table) -> pa.Table:
    """One bucket: the spans of the keys that were sent twice, or once by a buffer that held them twice."""
    def col(name, kind):
        return np.frombuffer(b"".join(group.column(name).to_pylist()), dtype=kind)

    a, b, flags = col("a", np.uint64), col("b", np.uint32), col("kind", np.int8)
    doc, tag, at = col("doc", np.int64), col("tag", np.int64), col("at", np.int32)
    settled = [col(n, k) for n, k in (("s_doc", np.int64), ("s_tag", np.int64), ("s_null", np.int8), ("s_at", np.int32), ("s_size", np.int32))]
    tables = [_span_batch(*settled)]
    if len(a):
        known, null = flags & 1, flags >> 1
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        gid = np.cumsum(np.concatenate([[False], ~same]))
        often = (np.bincount(gid) > 1) | (np.bincount(gid, weights=known[order]) > 0)
        repeated = np.empty(len(a), bool)
        repeated[order] = often[gid]
        i = np.flatnonzero(repeated & (known == 0))
        if len(i):
            joined = (np.diff(at[i]) == 1) & (np.diff(doc[i]) == 0) & (np.diff(tag[i]) == 0)
            starts = np.flatnonzero(np.concatenate([[True], ~joined]))
            sizes = np.diff(np.append(starts, len(i)))
            s = i[starts]
            tables.append(_span_batch(doc[s], tag[s], null[s], at[s], sizes))
    return pa.concat_tables(tables)
