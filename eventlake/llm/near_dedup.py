"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Words lose case and punctuation; a text is the sequence of its ``SHINGLE``-word
shingles (a shorter text is one shingle). Two texts are near-duplicates when
the longest common subsequence of their shingle sequences, over all shingles of
both (common ones once), is at least ``similarity``.

1. One pass signs every text: for each of ``ELEMENTS`` hash functions, the two
   smallest occurrence-labelled shingles, in text order. Equal neighbouring
   elements put two texts into one bucket (``ELEMENTS`` keys per text). Equal
   word sequences share one node and stand for all their copies.
2. In every bucket each text is paired with the bucket's hub, the member that
   shares most bucket places with others: a star, not all pairs.
3. Pairs are verified: the multiset bound rejects, an ordered run of unique
   shingles accepts, and what is left goes through a banded alignment, whose
   band follows from the similarity asked for.
4. Verified links become classes by label propagation with pointer jumping.
5. Pairs that the stars left open - members of one bucket in different classes -
   are compared within the group of all texts that share a hub. There common
   shingles are counted exactly, pairs that reach the similarity as multisets
   are aligned, and a link is reported only where it joins two classes. Groups
   of more than ``GROUP_WORDS`` words are dealt into blocks, one task for each
   pair of blocks; no pair is left out and no list of pairs is made.

Every class gets the smallest id in it. A pair of similarity 0.8 shares a
bucket with probability over 0.9999. Node ids are 64-bit hashes.

Defined results: texts without a word, null texts among them, are classes of
their own; a null id sorts after all ids and stays null; rows that repeat an id
or a text are members of the class of their text; ties go to the smaller node;
an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as WN

from . import sketch
from .common import ROLL_A, ROLL_B, SEPARATORS, U64, buffers, cut, mix, row_groups, word_hashes
from .spans import KEY, keyed, with_key

SHINGLE = 5
SIMILARITY = 0.8
ELEMENTS = 32
GROUP_WORDS = 400_000  # words of a group that one task compares with each other
BITS = 27  # bitmap of the nodes whose words are needed again: 16 MB

SIGNED = "doc long, tag long, null_id boolean, node long, words int, sig binary"


def _signature(shingles: np.ndarray, elements: int) -> np.ndarray:
    """Order MinHash: per hash function the two least occurrence-labelled shingles, in text order."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    nth = np.empty(len(shingles), np.uint64)
    nth[order] = np.arange(len(shingles)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    labelled = mix(shingles + nth * U64(0x9E3779B97F4A7C15))
    out = np.empty(elements, np.uint64)
    step = max(1, (1 << 18) // len(labelled))
    for lo in range(0, elements, step):
        # values of well-mixed shingles times odd factors: their high bits decide the order
        values = labelled[None, :] * _FACTORS[lo : min(elements, lo + step), None]
        each = np.arange(len(values))
        one = values.argmin(axis=1)
        values[each, one] = U64(0xFFFFFFFFFFFFFFFF)
        two = values.argmin(axis=1) if len(labelled) > 1 else one
        early, late = shingles[np.minimum(one, two)], shingles[np.maximum(one, two)]
        out[lo : lo + len(values)] = mix(early * U64(0xA24BAED4963EE407) + mix(late))
    return out


_FACTORS = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x5851F42D4C957F2D)) | U64(1)
_PUNCTUATION = bytes(b for b in range(128) if not (chr(b).isalnum() or b in SEPARATORS))


def _words(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per group of rows: the rows, their words' hashes without case and punctuation, and each row's first word."""
    raw, offsets = buffers(batch.column("text"))
    for lo, hi in row_groups(offsets):
        texts = []
        for i in range(lo, hi):
            text = raw[offsets[i] : offsets[i + 1]].tobytes()
            text = text.lower() if text.isascii() else text.decode().lower().encode()
            texts.append(text.translate(None, _PUNCTUATION))
        ends = np.cumsum([0, *map(len, texts)])
        words, first = word_hashes(np.frombuffer(b"".join(texts), np.uint8), ends)
        yield lo, hi, words, first



def _nodes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Node of each text: a hash of its words; 0 for a text without words."""
    a = ROLL_A.spans(ROLL_A.prefix(words), first[:-1], first[1:])
    b = ROLL_B.spans(ROLL_B.prefix(words), first[:-1], first[1:])
    count = np.diff(first).astype(np.uint64)
    return np.where(count > 0, mix(a + mix(b + count)) | U64(1), U64(0)).view(np.int64)


def _sign(shingle: int, elements: int):
    def run(batches):
        for batch in batches:
            nodes, counts, sigs = [], [], []
            for lo, hi, words, first in _words(batch):
                nodes.append(_nodes(words, first))
                counts.append(np.diff(first))
                for i in range(hi - lo):
                    n = int(first[i + 1] - first[i])
                    if not n:
                        sigs.append(b"")
                        continue
                    mine = words[first[i] : first[i + 1]]
                    k = min(shingle, n)
                    at = np.arange(n - k + 1)
                    sigs.append(_signature(ROLL_A.spans(ROLL_A.prefix(mine), at, at + k), elements).tobytes())
            node = np.concatenate(nodes) if nodes else np.empty(0, np.int64)
            count = np.concatenate(counts) if counts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc", "tag", "null_id")), pa.array(node), pa.array(count, pa.int32()), pa.array(sigs, pa.binary())],
                names=["doc", "tag", "null_id", "node", "words", "sig"],
            )

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket keys of every signature: one per pair of neighbouring elements, around the end."""
    for batch in batches:
        node = batch.column("node").to_numpy()
        sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint64).reshape(len(node), -1)
        place = np.arange(sigs.shape[1], dtype=np.uint64)
        key = mix(sigs + mix(np.roll(sigs, -1, axis=1)) + place[None, :])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(node, sigs.shape[1]))], names=["key", "node"]
        )


def _sequences(wanted):
    """Words (16 bits each) of the texts whose node is in the bitmap; a bitmap may let a few others through."""

    def run(batches):
        for batch in batches:
            for _, _, words, first in _words(batch):
                node = _nodes(words, first)
                hit = np.flatnonzero(sketch.repeated(wanted.value, node.view(np.uint64), BITS) & (node != 0))
                _, once = np.unique(node[hit], return_index=True)
                hit = hit[once]
                short = (words >> U64(20)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[hit]), pa.array([short[first[i] : first[i + 1]].tobytes() for i in hit], pa.binary())], names=["node", "seq"]
                )

    return run


def aligned(x: np.ndarray, y: np.ndarray, least: int) -> int:
    """Longest common subsequence of two sequences, exact wherever it reaches ``least`` (banded)."""
    n, m = len(x), len(y)
    lo = 0
    while lo < min(n, m) and x[lo] == y[lo]:
        lo += 1
    hi = 0
    while hi < min(n, m) - lo and x[n - 1 - hi] == y[m - 1 - hi]:
        hi += 1
    x, y = x[lo : n - hi], y[lo : m - hi]
    least -= lo + hi
    if not len(x) or not len(y):
        return lo + hi
    if least > min(len(x), len(y)):
        return 0
    before, after = len(x) - max(0, least), len(y) - max(0, least)  # unmatched items that may come first on either side
    row = np.zeros(len(y) + 1, np.int32)
    for i in range(len(x)):
        a, b = max(0, i - before), min(len(y), i + after + 1)
        step = np.maximum(row[a + 1 : b + 1], row[a:b] + (y[a:b] == x[i]))
        if a:
            step[0] = max(step[0], row[a])
        row[a + 1 : b + 1] = np.maximum.accumulate(step)
        if b < len(y):
            row[b + 1 :] = np.maximum(row[b + 1 :], row[b])
    return lo + hi + int(row[-1])


def _ids(seq: bytes, shingle: int) -> np.ndarray:
    words = np.frombuffer(seq, "<u2").astype(np.uint64) + U64(1)
    k = min(shingle, len(words))
    at = np.arange(len(words) - k + 1)
    return ROLL_A.spans(ROLL_A.prefix(words), at, at + k)


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two shingle sequences align to at least ``similarity``."""
    n, m = len(x), len(y)
    least = int(np.ceil(similarity * (n + m) / (1 + similarity) - 1e-9))
    if least > min(n, m):
        return False
    ux, ix, cx = np.unique(x, return_index=True, return_counts=True)
    uy, iy, cy = np.unique(y, return_index=True, return_counts=True)
    both, px, py = np.intersect1d(ux, uy, assume_unique=True, return_indices=True)
    if int(np.minimum(cx[px], cy[py]).sum()) < least:
        return False
    once = (cx[px] == 1) & (cy[py] == 1)
    at = iy[py[once]][np.argsort(ix[px[once]])]
    if len(at) >= least and (np.diff(at) > 0).all():
        return True
    return aligned(x, y, least) >= least


def _verify(shingle: int, similarity: float):
    def run(batches):
        for batch in batches:
            a, b = batch.column("a_seq").to_pylist(), batch.column("b_seq").to_pylist()
            good = [similar(_ids(x, shingle), _ids(y, shingle), similarity) for x, y in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())], names=["a", "b", "good"])

    return run


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the least node of each connected component of ``a, b``; a table per round, none on the driver."""
    edges = cut(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = cut(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        parent = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = step.join(parent, "label", "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label"))
        done = cut(jumped, "labels")
        labels = done.select("node", "label")
        if done.filter("label <> old").isEmpty():
            return labels


def _open_links(label: np.ndarray, node: np.ndarray, seqs: list[bytes], first: np.ndarray, second: np.ndarray,
                block: np.ndarray, shingle: int, similarity: float) -> Iterator[tuple[int, int]]:
    """Links between members of different classes in one group, as many as it takes to join what can be joined.

    Common shingles are counted exactly through an inverted index, so a pair is aligned only when its
    shingles reach the similarity as multisets. With ``first != second`` only pairs across those two
    blocks count.
    """
    ids = [_ids(x, shingle) for x in seqs]
    sizes = np.array([len(x) for x in ids])
    owner = np.repeat(np.arange(len(ids)), sizes)
    token = np.concatenate(ids)
    order = np.lexsort((owner, token))
    new = np.concatenate([[True], (np.diff(token[order]) != 0) | (np.diff(owner[order]) != 0)])
    nth = np.arange(len(token)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    labelled = np.empty_like(token)  # the n-th occurrence of a shingle in its text
    labelled[order] = mix(token[order] + nth.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    _, token, often = np.unique(labelled, return_inverse=True, return_counts=True)
    posting = owner[np.argsort(token, kind="stable")]
    begin = np.cumsum(often) - often
    ends = np.cumsum(sizes)
    least = similarity / (1 + similarity)
    across = first[0] != second[0]
    label = label.copy()
    for i in range(len(ids)):
        mine = token[ends[i] - sizes[i] : ends[i]]
        mine = mine[often[mine] > 1]
        if not len(mine):
            continue
        n = often[mine]
        at = np.arange(int(n.sum())) + np.repeat(begin[mine] - (np.cumsum(n) - n), n)
        common = np.bincount(posting[at], minlength=len(ids))
        hit = (common >= np.ceil(least * (sizes + sizes[i]) - 1e-9)) & (label != label[i])
        if across:
            hit &= block != block[i]
        hit[: i + 1] = False
        for j in np.flatnonzero(hit).tolist():
            if label[j] != label[i] and similar(ids[i], ids[j], similarity):
                yield int(node[i]), int(node[j])
                label[label == label[j]] = label[i]


def _open_groups(shingle: int, similarity: float):
    """Rows of a partition sorted by group: one group in memory at a time."""

    def run(batches):
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            key = table.column("group").to_numpy()
            done = len(key) - int(np.searchsorted(key[::-1] != key[-1], True))  # the last group may go on
            yield _opened(table.slice(0, done), shingle, similarity)
            rest = table.slice(done)
        if rest is not None:
            yield _opened(rest, shingle, similarity)

    return run


def _opened(table: pa.Table, shingle: int, similarity: float) -> pa.RecordBatch:
    found: list[tuple[int, int]] = []
    if table.num_rows:
        key, node, label, first, second, block = (
            table.column(c).to_numpy() for c in ("group", "node", "label", "first", "second", "block")
        )
        seqs = table.column("seq").to_pylist()
        edges = np.flatnonzero(np.diff(key)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(key)], strict=True):
            if (label[lo:hi] != label[lo]).any():
                s = slice(lo, hi)
                found += _open_links(label[s], node[s], seqs[s], first[s], second[s], block[s], shingle, similarity)
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, similarity: float = SIMILARITY, elements: int = ELEMENTS,
) -> DataFrame:
    """One row per input row: doc, tag, null_id, node, the class's smallest id and whether the row is that document."""
    if not 2 <= elements <= len(_FACTORS):
        raise ValueError("elements must lie between 2 and 256")
    rows = keyed(docs, id_col, text_col)
    signed = cut(rows.mapInArrow(_sign(shingle, elements), SIGNED), "signatures")
    keys = signed.filter("node <> 0").select("node", "sig").mapInArrow(_keys, "key long, node long").distinct()
    inside = WN.Window.partitionBy("key")
    members = cut(keys.withColumn("size", F.count(F.lit(1)).over(inside)).filter("size > 1"), "buckets")

    def wanted(batches):
        for batch in batches:
            yield batch.column("node").to_numpy().view(np.uint64)

    bitmap = docs.sparkSession.sparkContext.broadcast(sketch.build(members.select("node"), wanted, BITS, 1, least=1))
    seqs = cut(rows.select("text").mapInArrow(_sequences(bitmap), "node long, seq binary").dropDuplicates(["node"]), "sequences")

    def verified(pairs: DataFrame) -> DataFrame:
        left = seqs.select(F.col("node").alias("a"), F.col("seq").alias("a_seq"))
        right = seqs.select(F.col("node").alias("b"), F.col("seq").alias("b_seq"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_seq", "b_seq")
        return cut(both.mapInArrow(_verify(shingle, similarity), "a long, b long, good boolean"), "verified")

    # the hub of a bucket shares most bucket places with others
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    scored = members.join(score, "node")
    hub = scored.groupBy("key").agg(F.max(F.struct("score", (-F.col("node")).alias("least"))).alias("hub"))
    star = members.join(hub.select("key", (-F.col("hub.least")).alias("hub")), "key").filter("node <> hub")
    pairs = star.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    tried = verified(pairs)
    label = components(tried.filter("good"))
    # What the stars left open: two members of a bucket are both members of its hub's group. A large
    # group is dealt into blocks, and each pair of blocks is a task of its own.
    group = star.select("hub", "node").union(star.select("hub", F.col("hub").alias("node"))).distinct()
    named = group.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = cut(named.join(seqs.select("node", (F.octet_length("seq") / 2).alias("words")), "node"), "groups")
    mixed = named.groupBy("hub").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum("words").alias("all"))
    mixed = mixed.filter("lo <> hi").select("hub", F.ceil(F.col("all") / GROUP_WORDS).cast("int").alias("blocks"))
    dealt = named.join(mixed, "hub").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = dealt.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    sides = sides.select(F.xxhash64("hub", "first", "second").alias("group"), "node", "label", "first", "second", "block").join(seqs, "node")
    sides = sides.repartition("group").sortWithinPartitions("group")
    more = cut(sides.mapInArrow(_open_groups(shingle, similarity), "a long, b long"), "open-links")
    if not more.isEmpty():
        label = components(tried.filter("good").select("a", "b").union(more))
    key = signed.select("doc", "tag", "null_id", "node", "words")
    whole = key.join(label, "node", "left").withColumn("label", F.when(F.col("node") != 0, F.coalesce("label", "node")))
    first = whole.filter("node <> 0").groupBy("label").agg(F.min(F.struct("null_id", "doc", "tag")).alias("first"), F.count(F.lit(1)).alias("members"))
    # stored first, so that no aggregate stands between the rows' exchange and the join: Spark can split a hot class
    out = whole.join(cut(first, "classes"), "label", "left")
    me = F.struct("null_id", "doc", "tag")
    leader = F.coalesce(F.col("first"), me)
    return out.select(
        "doc", "tag", "null_id", "node", F.when(~leader["null_id"], leader["doc"]).alias("class_id"),
        F.coalesce("members", F.lit(1)).alias("members"), (leader == me).alias("leads"),
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows, one document of each class: the one with the smallest id (one row of it, if it repeats)."""
    lead = classes(docs, id_col, text_col, **options).filter("leads").select("doc", "tag", "null_id").distinct()
    kept = with_key(docs, id_col, text_col).join(lead.hint("shuffle_hash"), KEY, "left_semi")
    return kept.dropDuplicates(KEY).select("row.*")
