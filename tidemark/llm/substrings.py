"""Substring dedup: fixed-block anchors probed by rolling windows, hits extended to exact repeats."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as T
from tidemark.sources.storage import scratch_path, shared_dir, shuffles_dropped

#: Words of a repeat that counts.
WINDOW = 20
#: Documents that are compared with each other before anything is shuffled.
ROWS = 1024
BYTES = 8 << 20
#: Hashes that one task takes in at once, about.
BUCKET = 4_000_000
#: Bytes of text in a group of documents, which answers come back to, about.
GROUP = 4 << 20
#: Bytes of text of the groups that meet in one task, about.
TASK = 32 << 20

_U = np.uint64


def _runs(batches):
    """Slices of up to ROWS rows and about BYTES of text (last column)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        total, start = 0, 0
        for i, size in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
            total += size
            if total > BYTES or i + 1 - start >= ROWS:
                yield batch.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One list per start, up to the next."""
    offsets = np.append(starts, len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(buckets)) >> _U(32)


def _codes(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 31 bits of a hash: what an anchor is known by."""
    return (_bucket(h, buckets) << _U(32)) | (h & _U(0xFFFFFFFE))


def _group(handle: np.ndarray, groups: int) -> np.ndarray:
    """The group of a document, as Spark's pmod has it."""
    return (handle % groups).astype(np.int32)


def _heads(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    n = len(sorted_columns[0])
    if not n:
        return np.zeros(0, np.int64)
    change = np.zeros(n, bool)
    change[0] = True
    for c in sorted_columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _by_group(owner: np.ndarray, group: np.ndarray, values: np.ndarray):
    """Values by owner, packed by the group of the owner.

    Gives the groups, then per group the lists of its owners, of how many values
    each has, and of the values.
    """
    order = np.lexsort((owner, group[owner]))
    owner, values = owner[order], values[order]
    one = _heads(owner)
    size = np.diff(np.append(one, len(owner))).astype(np.int32)
    each = group[owner[one]]
    part = _heads(each)
    return each[part], owner[one], part, _lists(size, part), _lists(values, one[part])


def _anchors(rows: DataFrame, window: int, buckets: int, groups: int) -> DataFrame:
    """``group``, ``handles`` of documents, ``sizes`` and ``codes``: their words' runs that meet an anchor elsewhere.

    The anchors are the documents' own blocks of half a window, end to end; any
    window holds a whole one. Every rolling run of that length is a probe. Both
    go to the hash's bucket, packed by slice; a run that is an anchor somewhere
    and occurs twice is a hit. A slice first compares its documents with each
    other: what meets there is a hit at once, and goes out once, however many
    documents hold it. A handle or code may stand for two by chance, which only
    makes more to compare later.
    """
    block = window // 2

    def probe(batches):
        for batch in _runs(batches):
            handle = batch.column("handle").to_numpy()
            hashes, owner, first = [], [], []
            for i, data in enumerate(T.as_bytes(batch.column("text"))):
                words = T.word_hashes(data)
                if len(words) < window:
                    continue
                h = T.window_hashes(words, block)
                hashes.append(h)
                owner.append(np.full(len(h), i, np.int32))
                first.append(np.arange(len(h)) % block == 0)
            if not hashes:
                continue
            h, who, anchor = (np.concatenate(x) for x in (hashes, owner, first))
            order = np.lexsort((who, h))
            h, who, anchor = h[order], who[order], anchor[order]
            at = _heads(h)
            size = np.diff(np.append(at, len(h)))
            known = np.logical_or.reduceat(anchor, at) & (size > 1)
            local = np.repeat(known, size)
            # Of the others each document's run goes once.
            one = _heads(h, who)
            once = np.zeros(len(h), bool)
            once[one] = True
            flag = np.logical_or.reduceat(anchor, one)
            mark = np.zeros(len(h), bool)
            mark[one] = flag
            lone = once & ~local
            sent = np.concatenate([h[at[known]], h[lone]])
            from_ = np.concatenate([np.full(known.sum(), -1, np.int32), who[lone]])
            is_anchor = np.concatenate([np.ones(known.sum(), bool), mark[lone]])
            yield from _packed(sent, from_, is_anchor, handle)
            hit = local & once
            if hit.any():
                codes = _codes(h[hit], buckets).view(np.int64)
                group, docs, part, size, lists = _by_group(who[hit], _group(handle, groups), codes)
                yield _row_batch(
                    (T.mix(group.astype(np.uint64)) % _U(buckets)).astype(np.int32),
                    _lists(handle[docs], part),
                    size,
                    pa.array([[]] * len(group), pa.list_(pa.int32())),
                    lists,
                )

    def _packed(h, who, is_anchor, handle):
        to = _bucket(h, buckets).astype(np.int32)
        order = np.lexsort((who, to))
        h, who, to, is_anchor = h[order], who[order], to[order], is_anchor[order]
        key = ((h & _U(0xFFFFFFFE)) | is_anchor.astype(np.uint64)).astype(np.uint32).view(np.int32)
        parts, pairs = _heads(to), _heads(to, who)
        count = np.diff(np.append(pairs, len(h))).astype(np.int32)
        named = np.where(who[pairs] < 0, 0, handle[who[pairs]])
        # The size of the part without a document is negative.
        count = np.where(who[pairs] < 0, -count, count)
        starts = np.searchsorted(pairs, parts)
        yield _row_batch(
            to[parts], _lists(named, starts), _lists(count, starts), _lists(key, parts),
            pa.array([[]] * len(parts), pa.list_(pa.int64())),
        )

    def _row_batch(to, handles, sizes, keys, codes):
        return pa.RecordBatch.from_arrays(
            [pa.array(to), handles, sizes, keys, codes], ["bucket", "handles", "sizes", "keys", "codes"]
        )

    def meet(table: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("group", pa.int32()), ("handles", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
             ("codes", pa.list_(pa.int64()))]
        )
        bucket = table["bucket"][0].as_py()
        known = pc.greater(pc.list_value_length(table["codes"]), 0)
        flat = lambda t, c: pc.list_flatten(t[c]).to_numpy()
        ready, table = table.filter(known), table.filter(pc.invert(known))
        name, code = [flat(ready, "handles")], [flat(ready, "codes")]
        name = [np.repeat(name[0], flat(ready, "sizes"))]
        if table.num_rows:
            size, handle = flat(table, "sizes").astype(np.int64), flat(table, "handles")
            key = flat(table, "keys").astype(np.int32).view(np.uint32)
            plain = key & np.uint32(0xFFFFFFFE)
            values, times = np.unique(plain, return_counts=True)
            anchors = np.unique(plain[(key & np.uint32(1)) == 1])
            hits = np.intersect1d(values[times > 1], anchors, assume_unique=True)
            if len(hits):
                who = np.repeat(np.where(size > 0, np.arange(len(size)), -1), np.abs(size))
                at = np.searchsorted(hits, plain)
                at[at == len(hits)] = 0
                found = (hits[at] == plain) & (who >= 0)
                name.append(handle[who[found]])
                code.append(plain[found].astype(np.int64) | (np.int64(bucket) << np.int64(32)))
        name, code = np.concatenate(name), np.concatenate(code)
        if not len(name):
            return schema.empty_table()
        handle, who = np.unique(name, return_inverse=True)
        group, docs, part, size, lists = _by_group(who, _group(handle, groups), code)
        return pa.table([pa.array(group), _lists(handle[docs], part), size, lists], schema=schema)

    packed = rows.select("handle", "text").mapInArrow(
        probe, "bucket int, handles array<bigint>, sizes array<int>, keys array<int>, codes array<bigint>"
    )
    met = packed.repartition(buckets, "bucket").groupBy("bucket")
    return met.applyInArrow(
        meet, "group int, handles array<bigint>, sizes array<int>, codes array<bigint>"
    )


def _later(rows: DataFrame, window: int, buckets: int) -> DataFrame:
    """By ``group`` the ``key``, ``tag``, ``sizes`` and ``starts`` of windows that also start earlier.

    Around each hit the windows are told by 64 bits of one hash and 32 of another
    with a multiplier of its own. A slice keeps the first of equal ones; its
    bucket keeps the first of all.
    """
    block = window // 2
    schema = (
        "bucket int, groups array<int>, key array<bigint>, tag array<bigint>, sizes array<int>,"
        " high array<bigint>, low array<int>, start array<int>, later array<int>"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def route(batches):
        for batch in _runs(batches):
            key, tag = batch.column("key").to_numpy(), batch.column("tag").to_numpy()
            group = batch.column("group").to_numpy()
            parts = []
            for i, data in enumerate(T.as_bytes(batch.column("text"))):
                words = T.word_hashes(data)
                mine = batch.column("codes")[i].values.to_numpy().view(np.uint64)
                # A window with a hit inside: the hit starts in it and ends in it.
                hit = np.isin(_codes(T.window_hashes(words, block), buckets), mine)
                upto = np.concatenate(([0], np.cumsum(hit)))
                n = len(words) - window + 1
                start = np.flatnonzero(upto[window - block + 1 :][:n] > upto[:n])
                if len(start):
                    parts.append(
                        (
                            np.full(len(start), i, np.int32),
                            start.astype(np.int32),
                            T.window_hashes(words, window, 1)[start],
                            T.window_hashes(words, window, 2)[start].astype(np.uint32),
                        )
                    )
            if not parts:
                continue
            who, start, high, low = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((start, key[who], low, high))
            who, start, high, low = who[order], start[order], high[order], low[order]
            at = _heads(high, low)
            first = np.repeat(at, np.diff(np.append(at, len(who))))
            same = (key[who] == key[who[first]]) & (start == start[first])
            to = _bucket(high, buckets).astype(np.int32)
            later = ~same
            if later.any():
                each, docs, part, size, lists = _by_group(who[later], group, start[later])
                yield _batch(
                    (T.mix(each.astype(np.uint64)) % _U(buckets)).astype(np.int32),
                    _lists(group[docs], part),
                    _lists(key[docs], part),
                    _lists(tag[docs], part),
                    size,
                    *[None] * 3,
                    lists,
                )
            who, start, high, low, to = (x[same] for x in (who, start, high, low, to))
            order = np.lexsort((start, who, to))
            who, start, high, low, to = (x[order] for x in (who, start, high, low, to))
            rows_, pairs = _heads(to), _heads(to, who)
            starts = np.searchsorted(pairs, rows_)
            count = np.diff(np.append(pairs, len(who))).astype(np.int32)
            yield _batch(
                to[rows_],
                _lists(group[who[pairs]], starts),
                _lists(key[who[pairs]], starts),
                _lists(tag[who[pairs]], starts),
                _lists(count, starts),
                _lists(high.view(np.int64), rows_),
                _lists(low.view(np.int32), rows_),
                _lists(start, rows_),
                None,
            )

    def _batch(to, *columns):
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 3]
        made = [
            pa.array([[]] * len(to), pa.list_(kind)) if c is None else c
            for c, kind in zip(columns, kinds)
        ]
        return pa.RecordBatch.from_arrays([pa.array(to), *made], names)

    def settle(table: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("group", pa.int32()), ("key", pa.list_(pa.int64())), ("tag", pa.list_(pa.int64())),
             ("sizes", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32()))]
        )
        flat = lambda t, c: pc.list_flatten(t[c]).to_numpy()
        known = pc.greater(pc.list_value_length(table["later"]), 0)
        ready, table = table.filter(known), table.filter(pc.invert(known))
        # Owners of the ready ones first, then those of the others.
        group, key, tag = (
            np.concatenate([flat(ready, c), flat(table, c)]) for c in ("groups", "key", "tag")
        )
        sizes = flat(ready, "sizes")
        who, late = np.repeat(np.arange(len(sizes)), sizes), flat(ready, "later")
        mine = flat(table, "sizes")
        if len(mine):
            owner = np.repeat(len(sizes) + np.arange(len(mine)), mine)
            high, low, start = flat(table, "high"), flat(table, "low"), flat(table, "start")
            order = np.lexsort((start, key[owner], low, high))
            owner, start, high, low = owner[order], start[order], high[order], low[order]
            at = _heads(high, low)
            first = np.repeat(at, np.diff(np.append(at, len(owner))))
            later = (key[owner] != key[owner[first]]) | (start != start[first])
            who, late = np.concatenate([who, owner[later]]), np.concatenate([late, start[later]])
        if not len(who):
            return schema.empty_table()
        each, docs, part, size, lists = _by_group(who, group, late)
        return pa.table(
            [pa.array(each), _lists(key[docs], part), _lists(tag[docs], part), size, lists], schema=schema
        )

    routed = rows.select("key", "tag", "group", "codes", "text").mapInArrow(route, schema)
    met = routed.repartition(buckets, "bucket").groupBy("bucket")
    return met.applyInArrow(
        settle, "group int, key array<bigint>, tag array<bigint>, sizes array<int>, starts array<int>"
    )


def repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``n_removed``, ``removed`` spans, and ``kept_sha256``.

    A word goes if a window of ``window`` words around it has the same words as
    one that starts earlier: in a smaller id, or in the same document before.
    Null ids come first. Spans (start, end) are maximal. The hash is that of the
    kept words joined by single spaces. Null texts have no words; rows with the
    same id and text are treated alike, none of them before the other; an empty
    table gives no rows.

    Texts are scanned where they lie; packed hashes go to buckets whose number
    grows with the words. What a bucket finds goes back packed by group of
    documents, where it meets their texts. Only documents with a hit are
    compared further.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    rows = T.narrow(docs, id_col, text_col).withColumn("key", T.id_key("doc_id"))
    rows = rows.withColumn("tag", F.xxhash64("text")).withColumn("handle", F.xxhash64("key", "tag"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 6 // BUCKET + 1)

    groups = min(max(4 * buckets, size // GROUP + 1), (1 << 31) - 1)
    rows = rows.withColumn("group", F.pmod("handle", F.lit(groups)).cast("int"))
    hits = _anchors(rows, window, buckets, groups)
    columns = (
        "doc_id bigint, key bigint, tag bigint, group int, codes array<bigint>, text string,"
        " n_words bigint, kept_sha256 string"
    )

    def split(docs: pa.Table, hits: pa.Table) -> pa.Table:
        """Documents without a hit are done; of the others the text goes on."""
        found = _answers(hits, ["handles"], "codes")
        made = []
        for handle, data in zip(docs["handle"].to_pylist(), _texts(docs)):
            codes = found.get((handle,))
            n, digest = _digest(data, None)
            done = codes is None
            made.append((codes, None if done else data.decode(), n, digest if done else None))
        codes, left, n, sha = zip(*made) if made else ((), (), (), ())
        return pa.table(
            [
                *(docs[c] for c in ("doc_id", "key", "tag", "group")),
                pa.array(codes, pa.list_(pa.int64())),
                pa.array(left, pa.string()),
                pa.array(n, pa.int64()),
                pa.array(sha, pa.string()),
            ],
            [c.split()[0] for c in columns.split(", ")],
        )

    # Cogroups are not split at run time, so their tasks are as many as the text asks for.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK + 1)
    meeting = lambda df: df.repartition(tasks, "group").groupBy("group")
    both = meeting(rows).cogroup(meeting(hits))
    at = scratch_path(spark, "repeats")
    # Else the hashes and texts that meet here would lie beside those of the second half.
    with shuffles_dropped(spark):
        both.applyInArrow(split, columns).write.option("compression", "zstd").parquet(at)
    done = spark.read.parquet(at)
    open_ = done.where("codes IS NOT NULL")
    later = _later(open_, window, buckets)
    out = "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<start:bigint,end:bigint>>, kept_sha256 string"

    def finish(docs: pa.Table, later: pa.Table) -> pa.Table:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        found = _answers(later, ["key", "tag"], "starts")
        made = []
        for key, tag, data in zip(docs["key"].to_pylist(), docs["tag"].to_pylist(), _texts(docs)):
            spans = _spans(found.get((key, tag), np.zeros(0, np.int64)), window)
            n, digest = _digest(data, spans)
            made.append((n, sum(e - s for s, e in spans), [{"start": s, "end": e} for s, e in spans], digest))
        n, gone, spans, sha = zip(*made) if made else ((), (), (), ())
        return pa.table(
            [docs["doc_id"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind),
             pa.array(sha, pa.string())],
            [c.split()[0] for c in out.split(", ")],
        )

    left = meeting(open_.select("doc_id", "key", "tag", "group", "text"))
    finished = left.cogroup(meeting(later)).applyInArrow(finish, out)
    plain = done.where("codes IS NULL").select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("removed"), "kept_sha256",
    )
    return plain.unionByName(finished)


def _texts(docs: pa.Table) -> list[bytes]:
    return docs["text"].cast(pa.binary()).to_pylist()


def _answers(table: pa.Table, owner: list[str], values: str) -> dict[tuple, np.ndarray]:
    """Distinct values by owner, out of packed rows."""
    size = pc.list_flatten(table["sizes"]).to_numpy()
    if not len(size):
        return {}
    names = list(zip(*(pc.list_flatten(table[c]).to_pylist() for c in owner)))
    flat = pc.list_flatten(table[values]).to_numpy()
    held: dict[tuple, list[np.ndarray]] = {}
    for name, part in zip(names, np.split(flat, np.cumsum(size)[:-1])):
        held.setdefault(name, []).append(part)
    return {name: np.unique(np.concatenate(parts)) for name, parts in held.items()}


def _spans(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Windows by their starts, joined where they overlap or adjoin."""
    if not len(starts):
        return []
    starts = np.unique(starts).astype(np.int64)
    at = np.flatnonzero(np.diff(starts, prepend=starts[0] - window - 1) > window)
    last = np.append(at[1:], len(starts)) - 1
    return list(zip(starts[at].tolist(), (starts[last] + window).tolist()))


def _digest(data: bytes, spans: list | None) -> tuple[int, str]:
    """Number of words, and the hash of those outside the spans."""
    digest, n, some = hashlib.sha256(), 0, False
    spans, at = spans or [], 0
    for found in T.words(data, T.PLAIN):
        kept, i, end = [], 0, len(found)
        while at < len(spans) and spans[at][0] < n + end:
            s, e = max(spans[at][0] - n, i), spans[at][1] - n
            kept += found[i:s]
            i = max(i, min(e, end))
            if e > end:
                break
            at += 1
        kept += found[i:]
        if kept:
            digest.update((b" " if some else b"") + b" ".join(kept))
            some = True
        n += end
    return n, digest.hexdigest()
