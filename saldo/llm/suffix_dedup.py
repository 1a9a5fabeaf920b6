"""Removal of long repeated byte strings with suffix arrays.

A byte of a text goes if it is covered by a string of SPAN bytes that also starts in a document with a smaller
doc_id. Strings are judged on the input. The steps:

1. Texts are packed into shards of SHARD_BYTES. Texts longer than that are cut into overlapping pieces.
2. Every string of SPAN bytes has an anchor: the least hash among its GRAM-byte substrings. Equal strings
   have equal anchors, so only anchors that two shards or two documents share can hold a repeat. Shards
   exchange the distinct anchors they have (4 bytes each), and learn which are shared.
3. Neighbouring strings with the same shared anchor form a segment. Segments are dealt out by
   anchor, so that all equal strings meet in one bucket. In a bucket, each sub-shard of at most
   SORT_BYTES of distinct segments gets a suffix array, by Larsson-Sadakane refinement to SPAN bytes
   (8, 16, 32, 50; only groups that are not yet told apart are sorted again), and Kasai's common
   prefixes between neighbours; suffixes with SPAN common bytes are one class, whose least doc_id
   counts. Classes of several sub-shards are merged by binary search in their sorted strings.
4. The strings whose class has a smaller doc_id than their own document go back to their shard.

Scale: an identical segment is sent once by a shard and sorted once. An anchor that is very frequent (a common
phrase in ever new surroundings) is not a bucket of its own: its strings are dealt out one by one, by a
hash of all their bytes, so that only equal strings meet. Nothing is dropped; the work and
the bytes moved follow the text and its repeats.

Defined cases: a null text is an empty one. A null doc_id counts as larger than any other, and such rows, like
repeated rows of one doc_id, never cover each other. Matches never cross documents. Only `doc_id`
and `text` are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import bound_batches
from saldo.session import staged

SPAN = 50
GRAM = 20
SHARD_BYTES = 4 << 20
SORT_BYTES = 2 << 20
ANCHOR_BYTES = 32 << 20  # text whose anchors one bucket of step 2 compares
BLOCK = 1 << 18  # places of a shard whose hashes are held at once
RUN = 4096  # strings in one segment at most
DEALT = 1 << 19  # segments or single strings that a shard deals out at once
COMPARED = 1 << 20  # occurrences of strings that a bucket compares with their least document at once
OFTEN_HERE, OFTEN = 32, 4  # an anchor is frequent: so many segments in a shard, in so many shards
UNKNOWN = np.iinfo(np.int64).max  # stands for a null doc_id
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)]


# ---- strings and anchors -------------------------------------------------------------------------

def words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number, in the order of the bytes."""
    out = np.empty(max(0, len(data) - 7), np.uint64)
    for o in range(min(8, len(out))):
        part = data[o : o + (len(data) - o) // 8 * 8].view(">u8")
        out[o::8] = part[: len(out[o::8])]
    return out


def anchors(data: np.ndarray) -> np.ndarray:
    """Anchor of the string of SPAN bytes from each place."""
    if len(data) < SPAN:
        return np.empty(0, np.uint64)
    w, n = words8(data), len(data) - GRAM + 1
    h = w[:n] * MIX[0]
    for o in (*range(8, GRAM - 7, 8), GRAM - 8):
        h ^= w[o : o + n] >> np.uint64(3)
        h *= MIX[1]
        h ^= h >> np.uint64(29)
    h *= MIX[2]
    width = SPAN - GRAM + 1
    step, have = 1, 1
    while have < width:
        step = min(have, width - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h


def string_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of all SPAN bytes from each of the places."""
    near, out = np.lib.stride_tricks.sliding_window_view(data, 8), np.zeros(len(places), np.uint64)
    for o in (*range(0, SPAN - 7, 8), SPAN - 8):
        out = (out ^ near[places + o].view(">u8")[:, 0]) * MIX[2]
        out ^= out >> np.uint64(31)
    return out


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, past): stretches of neighbouring strings with one anchor, inside one document and of RUN
    strings at most. Anchors are computed BLOCK places at a time; only marks of one byte cover all places."""
    n = max(0, len(data) - SPAN + 1)
    inside = np.ones(n, bool)
    for back in range(1, SPAN):  # strings that cross an end
        at = ends - back
        inside[at[(at >= 0) & (at < n)]] = False
    begins, held, last, before = inside.copy(), [np.empty(0, np.uint64)], np.uint64(0), False
    for a in range(0, n, BLOCK):
        block = anchors(data[a : a + BLOCK + SPAN - 1])
        here = inside[a : a + BLOCK]
        begins[a : a + BLOCK] &= (block != np.append(last, block[:-1])) | ~np.append(before, here[:-1])
        held.append(block[begins[a : a + BLOCK]])
        last, before = block[-1], here[-1]
    stops = inside
    stops[:-1] &= begins[1:] | ~inside[1:]
    keys, first, past = np.concatenate(held), np.flatnonzero(begins), np.flatnonzero(stops) + 1
    parts = -(-(past - first) // RUN)
    if (parts > 1).any():
        which = np.repeat(np.arange(len(first)), parts)
        part = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        keys, first, past = keys[which], first[which] + part * RUN, past[which]
        past = np.minimum(past, first + RUN)
    return keys, first, past


def codes(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (upper half) and 32 further bits (lower half) of an anchor."""
    mixed = keys * MIX[1]
    mixed ^= mixed >> np.uint64(33)
    n = np.uint64(buckets)
    return ((mixed % n) << np.uint64(32)) | ((mixed // n) & np.uint64(0xFFFFFFFF))


# ---- suffix arrays -------------------------------------------------------------------------------

def suffix_array(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places with SPAN bytes left in their segment, in the order of their next SPAN bytes. `left`: bytes
    left at each place. Each round doubles what is compared and sorts only unresolved groups."""
    words = words8(data)
    sa = np.flatnonzero(left >= 8).astype(np.int32)
    rank = np.zeros(len(data), np.int32)
    key = words[sa]
    del words
    order = np.argsort(key)
    sa, key = sa[order], key[order]
    new = np.ones(len(sa), bool)
    new[1:] = key[1:] != key[:-1]
    del order, key
    depth = 8
    while True:
        group = np.flatnonzero(new).astype(np.int32)
        which = np.cumsum(new, dtype=np.int32) - np.int32(1)
        rank[sa] = group[which]
        if depth == SPAN:
            return sa
        step = min(depth, SPAN - depth)
        stay = left[sa] >= depth + step
        sa, which = sa[stay], which[stay]
        depth += step
        new = np.ones(len(sa), bool)
        new[1:] = which[1:] != which[:-1]
        open_ = np.zeros(len(sa), bool)  # places in groups of two or more
        open_[:-1] |= ~new[1:]
        open_[1:] |= ~new[1:]
        at = np.flatnonzero(open_)
        if len(at):
            following = rank[sa[at] + step]
            order = np.argsort((which[at].astype(np.int64) << 32) | following)
            sa[at] = sa[at][order]
            same = np.zeros(len(sa), np.int32)
            same[at] = following[order]
            new[1:] = (which[1:] != which[:-1]) | (same[1:] != same[:-1])


def common_prefixes(data: np.ndarray, left: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Common bytes of each suffix and the one before it in the suffix array, SPAN at most. Kasai's bound: two
    neighbours one byte further on share one byte less. As strings are only sorted to SPAN bytes, it is used
    where these two are neighbours again. It is carried along the text in eight interleaved passes, each
    over all places of one remainder together."""
    before = np.full(len(data), -1, np.int32)
    before[sa[1:]] = sa[:-1]
    words = words8(np.concatenate([data, np.zeros(16, np.uint8)]))
    shared = np.zeros(len(data), np.int8)
    for lane in range(8):
        at = np.arange(lane, len(data), 8)
        at = at[before[at] >= 0]
        moved = (before[at - 1] + 1 == before[at]) & (before[at - 1] >= 0) if lane else np.zeros(len(at), bool)
        known = np.where(moved, np.maximum(shared[at - 1] - 1, 0), 0)
        other, open_ = before[at], np.arange(len(at))
        while len(open_):
            k = known[open_]
            a, b = at[open_] + k, other[open_] + k
            room = np.minimum(np.minimum(left[at[open_]], left[other[open_]]), SPAN) - k
            differ = words[a] ^ words[b]
            equal = np.full(len(differ), 8, np.int64)
            for byte in range(7, -1, -1):
                equal[(differ >> np.uint64(56 - 8 * byte)) != 0] = byte
            gain = np.minimum(equal, np.maximum(room, 0))
            known[open_] = k + gain
            open_ = open_[(gain == 8) & (room > 8)]
        shared[at] = known
    return shared[sa]


def string_classes(segments: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For one sub-shard: the class of each string of each segment, one after the other; its bytes and the places of
    the sorted distinct strings in them; the least doc_id of each."""
    data = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(x) for x in segments])
    ends = np.cumsum(sizes)
    left = np.repeat(ends.astype(np.int32), sizes) - np.arange(len(data), dtype=np.int32)
    sa = suffix_array(data, left)
    first = common_prefixes(data, left, sa) < SPAN
    first[:1] = True
    starts = np.flatnonzero(first)
    owner = np.repeat(least, sizes)
    smallest = np.minimum.reduceat(owner[sa], starts)
    place = np.full(len(data), -1, np.int32)
    place[sa] = np.cumsum(first) - 1
    return place[left >= SPAN], data, sa[starts], smallest


def strings_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The strings of SPAN bytes from the places, as sortable fixed-width values."""
    if not len(places):
        return np.empty(0, f"S{SPAN}")
    return np.lib.stride_tricks.sliding_window_view(data, SPAN)[places].copy().view(f"S{SPAN}")[:, 0]


def least_documents(segments: list[bytes], least: np.ndarray, sort_bytes: int = SORT_BYTES) -> np.ndarray:
    """Least doc_id among equal strings, for each string of each segment."""
    parts, held, size = [], [], 0
    for i, segment in enumerate(segments):
        if held and size + len(segment) > sort_bytes:
            parts.append(held)
            held, size = [], 0
        held.append(i)
        size += len(segment)
    parts.append(held)
    found = [string_classes([segments[i] for i in p], least[p]) for p in parts]
    if len(found) > 1:  # cross-shard: look the strings of each sub-shard up in all others, two at a time
        smallest = [x[3].copy() for x in found]
        for i, (_, data, places, docs) in enumerate(found):
            own = strings_at(data, places)
            for j in range(i + 1, len(found) if len(own) else 0):
                other = strings_at(*found[j][1:3])
                if len(other):
                    at = np.minimum(np.searchsorted(other, own), len(other) - 1)
                    hit = np.flatnonzero(other[at] == own)
                    at = at[hit]  # strings are distinct, so a place comes once
                    smallest[i][hit] = np.minimum(smallest[i][hit], found[j][3][at])
                    smallest[j][at] = np.minimum(smallest[j][at], docs[hit])
        return np.concatenate([s[x[0]] for x, s in zip(found, smallest, strict=True)])
    return found[0][3][found[0][0]]


# ---- the steps as Spark jobs ---------------------------------------------------------------------

def pack(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def make_shards(size: int):
    """Texts packed into shards; a text longer than a shard becomes pieces that overlap by SPAN - 1 bytes."""

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=3).compress
        docs: list[int] = []
        texts: list[bytes] = []

        def shard(docs, texts, giant=None, piece=None):
            nonlocal number
            number += 1
            ends = np.cumsum([len(x) for x in texts])
            row = (number, giant, piece, pack(np.array(docs), "<i8"), pack(ends, "<i8"), squeeze(b"".join(texts)))
            return pd.DataFrame([row], columns=["shard", "giant", "piece", "docs", "ends", "body"]).astype(
                {"giant": "Int64", "piece": "Int64"}
            )

        held = 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc = UNKNOWN if pd.isna(doc) else int(doc)
                data = text.encode("utf-8", "surrogatepass") if text else b""
                if len(data) > size:
                    giant = number + 1
                    for i, a in enumerate(range(0, len(data), size)):
                        yield shard([doc], [data[a : a + size + SPAN - 1]], giant, i)
                    continue
                docs.append(doc)
                texts.append(data)
                held += len(data)
                if held >= size:
                    yield shard(docs, texts)
                    docs, texts, held = [], [], 0
        if docs:
            yield shard(docs, texts)

    return shards


SHARD = "shard long, giant long, piece long, docs binary, ends binary, body binary"


def opened(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, ends, doc_ids) of a shard row."""
    data = zstandard.ZstdDecompressor().decompress(row.body) if row.body else b""
    return np.frombuffer(data, np.uint8), np.frombuffer(row.ends, "<i8"), np.frombuffer(row.docs, "<i8")


def send_anchors(buckets: int, often_here: int):
    """The distinct anchors of each shard, by bucket. Flags: 1 two documents of the shard have it, 2 often."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                data, ends, _ = opened(row)
                keys, first, _ = runs(data, ends)
                if not len(keys):
                    continue
                code = codes(keys, buckets)
                order = np.argsort(code)
                code, doc = code[order], np.searchsorted(ends, first[order], side="right")
                new = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                several = np.maximum.reduceat(doc, new) != np.minimum.reduceat(doc, new)
                often = np.diff(np.append(new, len(code))) >= often_here
                code, flags = code[new], (several + 2 * often).astype(np.uint8)
                bucket = (code >> np.uint64(32)).astype(np.int64)
                at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                rows = [
                    (int(bucket[a]), row.shard, pack(code[a:b] & np.uint64(0xFFFFFFFF), "<u4"), flags[a:b].tobytes())
                    for a, b in zip(at, np.append(at[1:], len(code)), strict=True)
                ]
                yield pd.DataFrame(rows, columns=["bucket", "shard", "keys", "flags"])

    return send


def shared_anchors(often: int):
    """Of one bucket: which anchors of each shard two shards or documents share, and which are frequent."""

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, "<u4") for x in group["keys"]]
        sizes = np.array([len(x) for x in keys])
        flat, flags = np.concatenate(keys), np.frombuffer(b"".join(group["flags"]), np.uint8)
        order = np.argsort(flat)
        new = np.append(True, flat[order][1:] != flat[order][:-1])
        start, which = np.flatnonzero(new), np.empty(len(flat), np.int64)
        which[order] = np.cumsum(new) - 1
        several = (np.diff(np.append(start, len(flat))) > 1) | (np.maximum.reduceat(flags[order] & 1, start) > 0)
        frequent = np.add.reduceat((flags[order] >> 1).astype(np.int64), start) >= often
        several, frequent = several[which], frequent[which]
        bounds, rows = np.concatenate(([0], np.cumsum(sizes))), []
        for shard, bucket, a, b in zip(group["shard"], group["bucket"], bounds[:-1], bounds[1:], strict=True):
            if (keep := several[a:b]).any():
                rows.append((shard, bucket, pack(flat[a:b][keep], "<u4"), frequent[a:b][keep].astype(np.uint8).tobytes(), int(keep.sum())))
        return pd.DataFrame(rows, columns=["shard", "bucket", "keys", "often", "n"])

    return shared


def send_segments(anchor_buckets: int, buckets: int):
    """Segments with a shared anchor, by bucket: distinct segments once, and where they occur."""

    def dealt(row, found) -> Iterator[list[tuple]]:
        data, ends, docs = opened(row)
        keys, first, past = runs(data, ends)
        code = codes(keys, anchor_buckets)
        wanted = np.concatenate([(np.uint64(x["bucket"]) << np.uint64(32)) | np.frombuffer(x["keys"], "<u4").astype(np.uint64) for x in found])
        often = np.concatenate([np.frombuffer(x["often"], np.uint8) for x in found])
        order = np.argsort(wanted)
        wanted, often = wanted[order], often[order]
        at = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
        hit = np.flatnonzero(wanted[at] == code)
        keys, first, past, single = keys[hit], first[hit], past[hit], often[at[hit]] > 0
        upto = np.cumsum(np.where(single, past - first, 1))
        edges = np.flatnonzero(np.diff(upto // DEALT, prepend=-1))  # where a further DEALT of them begin
        for x, y in zip(edges, np.append(edges[1:], len(upto)), strict=True):
            yield list(pieces(row.shard, data, ends, docs, keys[x:y], first[x:y], past[x:y], single[x:y]))

    def pieces(shard, data, ends, docs, keys, first, past, single) -> Iterator[tuple]:
        plain = ~single
        a, b = first[plain], past[plain] + SPAN - 1
        bucket = (keys[plain] * MIX[0] >> np.uint64(20)) % np.uint64(buckets)
        if single.any():
            sizes = past[single] - first[single]
            each = np.repeat(first[single] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            a, b = np.append(a, each), np.append(b, each + SPAN)
            bucket = np.append(bucket, string_hashes(data, each) % np.uint64(buckets))
        order = np.argsort(bucket, kind="stable")
        a, b, bucket = a[order], b[order], bucket[order].astype(np.int64)
        owner = docs[np.searchsorted(ends, a, side="right")]
        text, squeeze = memoryview(data), zstandard.ZstdCompressor(level=1).compress
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for x, y in zip(edges, np.append(edges[1:], len(a)), strict=True):
            seen: dict[bytes, int] = {}
            place = [seen.setdefault(bytes(text[i:j]), len(seen)) for i, j in zip(a[x:y].tolist(), b[x:y].tolist(), strict=True)]
            yield (
                int(bucket[x]), shard, squeeze(b"".join(seen)), squeeze(pack(np.array([len(s) for s in seen]), "<u4")),
                squeeze(pack(np.array(place), "<u4")), squeeze(pack(a[x:y], "<u4")), squeeze(pack(owner[x:y], "<i8")),
            )

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                for rows in dealt(row, row.found):
                    yield pd.DataFrame(rows, columns=["bucket", "shard", "strings", "sizes", "which", "starts", "owners"])

    return send


def match(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the stretches of strings, by shard, that a smaller doc_id has too."""
    seen: dict[bytes, int] = {}
    which, starts, owners, shards = [], [], [], []
    opened_ = zstandard.ZstdDecompressor().decompress
    for row in group.itertuples():
        own, at, strings = [], 0, opened_(row.strings)
        for n in np.frombuffer(opened_(row.sizes), "<u4").tolist():
            own.append(seen.setdefault(strings[at : at + n], len(seen)))
            at += n
        which.append(np.array(own)[np.frombuffer(opened_(row.which), "<u4")])
        starts.append(np.frombuffer(opened_(row.starts), "<u4").astype(np.int64))
        owners.append(np.frombuffer(opened_(row.owners), "<i8"))
        shards.append(np.full(len(starts[-1]), row.shard))
    which, starts, owners, shards = map(np.concatenate, (which, starts, owners, shards))
    least = np.full(len(seen), UNKNOWN)
    np.minimum.at(least, which, owners)
    smallest = least_documents(list(seen), least)
    count = np.array([len(s) - SPAN + 1 for s in seen])
    base = np.concatenate(([0], np.cumsum(count)[:-1]))
    rows = []
    step = max(1, COMPARED // int(count.max()))
    for x in range(0, len(which), step):
        w, n = which[x : x + step], count[which[x : x + step]]
        offset = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
        occ = np.repeat(np.arange(len(w)), n)
        old = smallest[base[w][occ] + offset] < owners[x : x + step][occ]
        begin = old.copy()
        begin[1:] &= ~old[:-1] | (occ[1:] != occ[:-1])
        end = old.copy()
        end[:-1] &= ~old[1:] | (occ[1:] != occ[:-1])
        i, j = np.flatnonzero(begin), np.flatnonzero(end)
        if len(i):
            rows.append((shards[x : x + step][occ[i]], starts[x : x + step][occ[i]] + offset[i], starts[x : x + step][occ[j]] + offset[j] + SPAN))
    if not rows:
        return pd.DataFrame({"shard": [], "begins": [], "stops": []})
    shard, begin, stop = map(np.concatenate, zip(*rows, strict=True))
    order = np.argsort(shard, kind="stable")
    shard, begin, stop = shard[order], begin[order], stop[order]
    at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    return pd.DataFrame(
        [(int(shard[a]), pack(begin[a:b], "<u4"), pack(stop[a:b], "<u4")) for a, b in zip(at, np.append(at[1:], len(shard)), strict=True)],
        columns=["shard", "begins", "stops"],
    )


RESULT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", "giant", "piece", "size", "gone"]
REMAINS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string, giant long, piece long, size long, gone binary"


def kept_of(doc: int, data: np.ndarray, gone: np.ndarray, with_text: bool) -> tuple:
    """Result of one document; `gone`: mark of each byte."""
    kept = data[~gone].tobytes()
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return (None if doc == UNKNOWN else doc, len(data), int(gone.sum()), spans, kept if with_text else None, hashlib.sha256(kept).hexdigest())


def covered(size: int, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Mark of each byte that a stretch covers. Stretches are merged first, so that a byte of memory marks a place."""
    mark = np.zeros(size + 1, np.int8)
    if len(begins):
        order = np.argsort(begins)
        begins, reach = begins[order], np.maximum.accumulate(stops[order])
        new = np.flatnonzero(np.append(True, begins[1:] > reach[:-1]))
        mark[begins[new]] = 1
        mark[reach[np.append(new[1:], len(begins)) - 1]] = -1
    return np.cumsum(mark[:-1], dtype=np.int8).view(bool)


def take_out(size: int, with_text: bool):
    """Cut the found stretches out of each shard's documents. Pieces of giant texts come back as they are,
    with the marks of their bytes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                data, ends, docs = opened(row)
                found = row.found if row.found is not None else ()
                begins, stops = (np.frombuffer(b"".join([x[c] for x in found]), "<u4") for c in ("begins", "stops"))
                gone = covered(len(data), begins, stops)
                if not pd.isna(row.giant):
                    marks = np.packbits(gone).tobytes()
                    rows = [(int(docs[0]), None, None, None, data.tobytes(), None, int(row.giant), int(row.piece), len(data), marks)]
                else:
                    begin = np.concatenate(([0], ends[:-1]))
                    rows = [
                        (*kept_of(int(d), data[a:b], gone[a:b], with_text), None, None, None, None)
                        for d, a, b in zip(docs, begin, ends, strict=True)
                    ]
                out = pd.DataFrame(rows, columns=RESULT)
                whole = ["doc_id", "n_bytes", "n_removed", "n_spans", "giant", "piece", "size"]
                yield out.astype(dict.fromkeys(whole, "Int64"))

    return cut


def join_pieces(size: int, with_text: bool):
    """One result for the pieces of a giant text."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece")
        parts = [np.frombuffer(x, np.uint8) for x in group["kept"]]
        data = np.concatenate([*(x[:size] for x in parts[:-1]), parts[-1]])
        gone = np.zeros(len(data), bool)
        for i, (marks, n) in enumerate(zip(group["gone"], group["size"], strict=True)):
            own = np.unpackbits(np.frombuffer(marks, np.uint8), count=int(n)).astype(bool)
            gone[i * size : i * size + int(n)] |= own[: len(data) - i * size]
        row = kept_of(int(group["doc_id"].iloc[0]), data, gone, with_text)
        out = pd.DataFrame([row], columns=RESULT[:6])
        return out.astype(dict.fromkeys(RESULT[:4], "Int64"))

    return join


def drop_repeats(
    documents: DataFrame, shard_bytes: int = SHARD_BYTES, with_text: bool = True,
    often: tuple[int, int] = (OFTEN_HERE, OFTEN),
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every document; `kept` holds the remaining
    bytes, or null without `with_text`."""
    spark = documents.sparkSession
    bound_batches(spark)
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = staged(slim.mapInPandas(make_shards(shard_bytes), SHARD), "shards")
    total = shards.count() * shard_bytes
    anchor_buckets = max(1, ceil(total / ANCHOR_BYTES))
    told = shards.select("shard", "ends", "docs", "body").mapInPandas(
        send_anchors(anchor_buckets, often[0]), "bucket long, shard long, keys binary, flags binary"
    )
    shared = staged(
        told.groupBy("bucket").applyInPandas(shared_anchors(often[1]), "shard long, bucket long, keys binary, often binary, n long"), "anchors"
    )
    segments = shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, ceil(segments * 2 * SPAN / SORT_BYTES))
    lists = shared.groupBy("shard").agg(F.collect_list(F.struct("bucket", "keys", "often")).alias("found"))
    dealt = (
        shards.select("shard", "ends", "docs", "body").join(lists.hint("merge"), "shard")
        .mapInPandas(send_segments(anchor_buckets, buckets), "bucket long, shard long, strings binary, sizes binary, which binary, starts binary, owners binary")
    )
    stretches = staged(
        dealt.groupBy("bucket").applyInPandas(match, "shard long, begins binary, stops binary"), "stretches"
    )
    marks = stretches.groupBy("shard").agg(F.collect_list(F.struct("begins", "stops")).alias("found"))
    out = staged(
        shards.join(marks.hint("merge"), "shard", "left").mapInPandas(take_out(shard_bytes, with_text), REMAINS), "remains"
    )
    whole = out.where("giant is null").select(*RESULT[:6])
    giants = out.where("giant is not null").groupBy("giant").applyInPandas(
        join_pieces(shard_bytes, with_text), REMAINS.split(", giant")[0]
    )
    return whole.unionByName(giants)


def op5_suffix_array(documents: DataFrame) -> DataFrame:
    """Every document with what goes and a digest of what remains."""
    return drop_repeats(documents, with_text=False).drop("kept")
