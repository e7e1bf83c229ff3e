"""N-gram Jaccard join (operator 5): exact set-similarity classes by a prefix-tree join over globally ordered n-grams.

A document's set is its distinct shingles of five words, as 64-bit hashes. Documents with equal sets form a class,
named by a 64-bit hash of the set; everything after the first pass works on classes.

1. Global order. Shingles (here 48 bits of their hashes, so that two sets of 500 see a false common one with a
   probability below 10^-9) are dealt to buckets by hash and counted there: n-grams that only one class has come first,
   then the others by document frequency. One class can link to another only if at least 80 % of its n-grams occur
   elsewhere; all other classes leave here, and an n-gram of one class alone is never sent on. Each task sends a
   class's n-grams once per slice of its input; an n-gram that many classes of one slice share travels as a count,
   and its holders are told so directly, so no bucket collects a hot n-gram's holders.
2. Candidates. Two sets that link share an n-gram of both prefixes (the first n - ceil(0.8 n) + 1 of the order). Per
   prefix n-gram one leader is chosen, and each holder is compared with the best of its leaders; links found join components. A few rounds
   with other leaders follow, then every remaining pair of holders in different components whose places in the
   order leave room for the overlap needed. So a group of near copies
   costs about one comparison per member, no pair between different components is left out, and links inside a
   component need no search.
3. Comparison. Per leader, its candidates' ordered n-grams form a prefix tree, walked depth first: candidates with a
   common beginning share its partial overlap, and a branch ends when the overlap so far plus what can still come
   (the shorter of both remainders) stays below the overlap needed. Candidates of one leader are dealt to chunks.

Defined results: a document without words or text has an empty set, links with nothing and is its own component; fewer
than five words are one shingle; equal documents and repeated rows are one component; rows with a null id get a null
component and name none; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm.common import Scratch, beside, by_value, release_memory, tidy, worker_state
from terrane.llm.packing import slices

by_value(__name__)

SHINGLE = 5
#: Links: PERCENT * union <= 100 * intersection.
PERCENT = 80
BUCKET_NGRAMS = 1_000_000
#: So many buckets leave at most 40 of an n-gram's 48 bits to tell apart in each.
LEAST_BUCKETS = 260
#: N-grams of a bucket that are sorted at once.
RANGE_NGRAMS = 250_000
#: N-grams that so many classes of one slice share travel as counts; their document frequency counts as HOT.
HOT_HOLDERS, HOT = 32, 2**31 - 1
SLICE_BYTES, BLOCK_BYTES = 6 << 20, 1 << 20
LEADER_ROUNDS = 3
CHUNK = 256
SHARD_PAIRS = 4000

_U = np.uint64
BYTE_FACTOR, WORD_FACTOR = _U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, one to one."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHasher:
    """Hashes of all words of a buffer at once: sums of byte values times powers, taken from running sums."""

    def __init__(self):
        values = mix(np.arange(1, 257, dtype=_U))
        values[65:91] = values[97:123]  # A-Z count as a-z
        self.values = values
        self.space = np.isin(np.arange(256), [32, *range(9, 14)])
        self.inverse = _U(pow(int(BYTE_FACTOR), -1, 2**64))
        self.powers = self.inverses = np.ones(1, _U)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words data[starts:ends], in blocks that begin and end with words."""
        out = np.zeros(len(starts), _U)
        cuts = np.unique(np.searchsorted(starts, np.arange(0, len(data) + BLOCK_BYTES, BLOCK_BYTES)))
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            first, last = int(starts[i]), int(ends[j - 1])
            if len(self.powers) < last - first:
                self.powers = np.cumprod(np.concatenate([[_U(1)], np.full(last - first, BYTE_FACTOR)]))
                self.inverses = np.cumprod(np.concatenate([[_U(1)], np.full(last - first, self.inverse)]))
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(self.values[data[first:last]] * self.powers[:last - first])])
            a, b = starts[i:j] - first, ends[i:j] - first
            out[i:j] = mix((sums[b] - sums[a]) * self.inverses[a] + (b - a).astype(_U))
        return out


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, one text after the other (sorted within it), and their number per text."""
    hasher = worker_state("word_hasher", WordHasher)
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    bounds = offsets - offsets[0]
    inside = ~hasher.space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    text_starts = bounds[:-1][bounds[:-1] < len(data)]
    begins[text_starts] |= inside[text_starts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | begins[1:]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    words = hasher.hashes(data, starts, ends)
    word_at = np.searchsorted(starts, bounds)  # first word of each text
    m = max(0, len(words) - SHINGLE + 1)
    grams = np.zeros(m, _U)
    for k in range(SHINGLE):
        grams = grams * WORD_FACTOR + words[k:k + m]
    grams = mix(grams)
    sets = []
    for a, b in zip(word_at[:-1].tolist(), word_at[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            sets.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif b > a:
            whole = _U(b - a)
            for w in words[a:b]:
                whole = whole * WORD_FACTOR + w
            sets.append(mix(np.array([whole], _U)))
        else:
            sets.append(np.zeros(0, _U))
    return np.concatenate(sets) if sets else np.zeros(0, _U), np.array([len(s) for s in sets], np.int64)


def signatures(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit name per set, whatever the order of its members (0 for empty sets)."""
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(tokens ^ _U(0x5851F42D4C957F2D)))])
    ends = np.cumsum(sizes)
    return np.where(sizes > 0, mix(sums[ends] - sums[ends - sizes] + sizes.astype(_U)), _U(0))


def set_signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (set size), sig (name of the set) of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
                tokens, sizes = shingles(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes), pa.array(signatures(tokens, sizes).view(np.int64))],
                    names=["doc_id", "n", "sig"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(sign), f"doc_id {id_type}, n long, sig long")


def _dealt(docs: DataFrame, n_buckets: int, text_col: str) -> DataFrame:
    """N-grams of the classes of each slice, packed by bucket.

    kind 0: sigs, counts (n-grams of each) and tokens. kind 1: tokens that are hot in the slice. kind 2: what kind 0
    holds, but of hot n-grams and dealt by class, to be passed on.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in (part for whole in batches for part in slices(whole, 0, SLICE_BYTES)):
                tokens, sizes = shingles(batch.column(0))
                sigs = signatures(tokens, sizes)
                _, first = np.unique(sigs, return_index=True)
                chosen = np.zeros(len(sigs), bool)
                chosen[first] = True
                chosen &= sizes > 0
                tokens, owner = tokens[np.repeat(chosen, sizes)], np.repeat(sigs[chosen], sizes[chosen])
                if not len(tokens):
                    continue
                order = np.argsort(tokens, kind="stable")
                ordered = tokens[order]
                edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
                held = np.diff(edges)
                hot = np.zeros(len(tokens), bool)
                hot[order] = np.repeat(held >= HOT_HOLDERS, held)
                rows = []
                hot_tokens = ordered[edges[:-1]][held >= HOT_HOLDERS]
                for bucket, own in _by_bucket(_bucket_of(hot_tokens, n_buckets)):
                    rows.append((bucket, 1, None, None, _packed_in(hot_tokens[own], bucket, n_buckets)))
                for kind, mask in ((0, ~hot), (2, hot)):
                    some, holders = tokens[mask], owner[mask]
                    for bucket, own in _by_bucket(_bucket_of(some if kind == 0 else holders, n_buckets)):
                        # tokens of a class stay next to each other
                        blob = _packed_in(some[own], bucket, n_buckets) if kind == 0 else _packed(some[own])
                        rows.append((bucket, kind, *_runs_of(holders[own]), blob))
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                                 names=["bucket", "kind", "sigs", "counts", "tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(
        tidy(deal), "bucket long, kind int, sigs binary, counts binary, tokens binary")


def _packed(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each n-gram hash, six bytes each."""
    return np.ascontiguousarray((tokens >> _U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _low_end(bucket: int, n_buckets: int) -> np.uint64:
    """The least 48-bit n-gram of a bucket."""
    return _U(-(-(bucket << 32) // n_buckets) << 16)


def _packed_in(tokens: np.ndarray, bucket: int, n_buckets: int) -> bytes:
    """The upper 48 bits of n-gram hashes of one bucket, counted from its low end: five bytes each."""
    rest = (tokens >> _U(16)) - _low_end(bucket, n_buckets)
    return np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpacked_in(raw: np.ndarray, bucket: int, n_buckets: int) -> np.ndarray:
    """The 48-bit n-grams of rows of five bytes."""
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    return wide.reshape(-1).view("<u8") + _low_end(bucket, n_buckets)


def _bytes_of(blobs: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)


def _runs_of(sigs: np.ndarray) -> tuple[bytes, bytes]:
    """Runs of equal class names: the names and their 16-bit lengths (a longer run is cut)."""
    edges = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1], [True]]))
    edges = np.unique(np.concatenate([edges, *(np.arange(a, b, 65_535) for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 65_535)]))
    return sigs[edges[:-1]].tobytes(), np.diff(edges).astype(np.uint16).tobytes()


def _whole(blobs: pd.Series) -> np.ndarray:
    """The 48-bit n-grams of rows of six bytes."""
    parts = np.frombuffer(b"".join(blobs), "<u2").reshape(-1, 3)
    return parts[:, 0] | parts[:, 1].astype(_U) << _U(16) | parts[:, 2].astype(_U) << _U(32)


def _bucket_of(tokens: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes."""
    return ((tokens >> _U(32)) * _U(n_buckets)) >> _U(32)


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its entries, in their order."""
    order = np.argsort(buckets, kind="stable")
    ordered = buckets[order]
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])) if len(ordered) else []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(ordered[a]), order[a:b]


def _owners(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted names of the classes, and for each n-gram of the rows the place of its class there."""
    sigs = np.frombuffer(b"".join(part["sigs"]), _U)
    counts = np.frombuffer(b"".join(part["counts"]), np.uint16)
    names, place = np.unique(sigs, return_inverse=True)
    return names, np.repeat(place.astype(np.uint32), counts)


def _ranges(raw: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Places of n-grams of five bytes, range by range, about ``most`` in each (equal n-grams stay together)."""
    top = raw[:, 4].astype(np.uint16) << np.uint16(8) | raw[:, 3]
    n_ranges = -(-len(top) // most)
    if n_ranges < 2:
        yield np.arange(len(top))
        return
    low, high = int(top.min()), int(top.max()) + 1
    edges = [low + (high - low) * k // n_ranges for k in range(n_ranges + 1)]
    for x, y in zip(edges[:-1], edges[1:], strict=True):
        yield np.flatnonzero((top >= x) & (top < y))


def _dealt_by_class(names: np.ndarray, owner: np.ndarray, tokens: np.ndarray, frequency: np.ndarray, n_buckets: int) -> list[tuple]:
    """Rows (bucket of classes, sigs, counts, tokens, df); names ascend, and so do the buckets, which are ranges."""
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    buckets = _bucket_of(names, n_buckets)[owner]
    edges = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1)).tolist() if len(buckets) else []
    rows = []
    for x, y in zip(edges[:-1], edges[1:], strict=True):
        own = order[x:y]
        rows.append((int(buckets[x]), *_runs_of(names[owner[x:y]]), _packed(tokens[own] << _U(16)), frequency[own].tobytes()))
    return rows


def _shared_ngrams(bucket: int, part: pd.DataFrame, n_buckets: int, class_buckets: int) -> pd.DataFrame:
    """N-grams of a bucket that more than one class holds, with their document frequency, packed by bucket of classes.

    Ranges of the bucket are sorted one after the other, so that little stands in memory beside the bucket itself.
    """
    hot = np.unique(_unpacked_in(_bytes_of(part.loc[part["kind"] == 1, "tokens"], 5), bucket, n_buckets))
    given = part[part["kind"] == 0]
    names, owner = _owners(given)
    raw = _bytes_of(given["tokens"], 5)
    owners, shared, frequencies = [], [], []
    for at in _ranges(raw, RANGE_NGRAMS):
        tokens, own = _unpacked_in(raw[at], bucket, n_buckets), owner[at]
        order = np.lexsort((own, tokens))  # copies of a class in other slices fall together
        tokens, own = tokens[order], own[order]
        if not len(tokens):
            continue
        new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (own[1:] != own[:-1])])
        tokens, own = tokens[new], own[new]
        edges = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
        held = np.diff(edges).astype(np.uint32)
        held[np.isin(tokens[edges[:-1]], hot, kind="sort")] = HOT
        several = np.repeat(held > 1, np.diff(edges))
        owners.append(own[several])
        shared.append(tokens[several])
        frequencies.append(np.repeat(held, np.diff(edges))[several])
    rows = []
    if owners:
        rows += _dealt_by_class(names, np.concatenate(owners), np.concatenate(shared), np.concatenate(frequencies), class_buckets)
    passed = part[part["kind"] == 2]
    if len(passed):
        names, owner = _owners(passed)
        tokens = _whole(passed["tokens"])
        rows += _dealt_by_class(names, owner, tokens, np.full(len(tokens), HOT, np.uint32), class_buckets)
    out = pd.DataFrame(rows, columns=["bucket", "sigs", "counts", "tokens", "df"])
    release_memory()
    return out


def _linkable(part: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket of classes: distinct shared n-grams of each class in global order, as (sig, tokens)."""
    names, owner = _owners(part)
    tokens = _whole(part["tokens"])
    order = np.lexsort((tokens, np.frombuffer(b"".join(part["df"]), np.uint32), owner))
    owner, tokens = owner[order], tokens[order]
    del order
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1])
    owner, tokens = owner[new], tokens[new].view(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else np.zeros(1, int)
    listed = pd.Series([tokens[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)], dtype=object)
    return pd.DataFrame({"sig": names[owner[edges[:-1]]].view(np.int64), "tokens": listed})


def needed_share(n: Column) -> Column:
    """N-grams of a set of n that a partner must have."""
    return F.ceil(n * PERCENT / 100.0 - 1e-9).cast("int")


def linkable_sets(docs: DataFrame, members: DataFrame, n_buckets: int, text_col: str = "text") -> DataFrame:
    """sig, n, tokens: shared n-grams in global order of every class that can have a partner."""
    class_buckets, n_buckets = n_buckets, max(n_buckets, LEAST_BUCKETS)
    shared = (_dealt(docs, n_buckets, text_col).groupBy("bucket")
              .applyInPandas(lambda key, part: _shared_ngrams(int(key[0]), part, n_buckets, class_buckets),
                             "bucket long, sigs binary, counts binary, tokens binary, df binary"))
    whole = shared.groupBy("bucket").applyInPandas(_linkable, "sig long, tokens array<long>")
    classes = members.where("n > 0").groupBy("sig").agg(F.first("n").alias("n"))
    return (whole.join(classes, "sig").where(F.size("tokens") >= needed_share(F.col("n")))
            .select("sig", "n", "tokens"))


def overlaps_enough(probe_tokens: np.ndarray, probe_n: int, sizes: list[int], tokens: list[np.ndarray]) -> list[int]:
    """Which candidates link with the probe: a walk over the prefix tree of their ordered n-grams.

    The tree's paths are visited in order, so a candidate starts from the partial overlap at the node where it leaves
    the path before it.
    """
    place = {t: i for i, t in enumerate(probe_tokens.tolist())}
    m, linked = len(place), []
    order = sorted(range(len(tokens)), key=lambda k: tokens[k].tobytes())
    path: np.ndarray = np.zeros(0, np.int64)
    # by depth on the present path: overlap so far, and the last place of the probe that is used up
    state = [(0, -1)]
    for k in order:
        own = tokens[k]
        total = sizes[k] + probe_n
        need = -(-PERCENT * total // (100 + PERCENT))
        common = min(len(own), len(path), len(state) - 1)
        differ = np.flatnonzero(own[:common] != path[:common])
        depth = int(differ[0]) if len(differ) else common
        del state[depth + 1:]
        overlap, used = state[depth]
        length = len(own)
        for t in own[depth:].tolist():
            if overlap + min(length - depth, m - 1 - used) < need:
                break
            at = place.get(t)
            if at is not None:
                overlap, used = overlap + 1, at
            depth += 1
            state.append((overlap, used))
        path = own
        if overlap >= need:
            linked.append(k)
    return linked


def verified_links(scratch: Scratch, name: str, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (probe, sig) whose sets link."""
    pairs = scratch.write(pairs, f"{name}-pairs")
    n_pairs = pairs.count()
    counts = pairs.groupBy("probe").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("long").alias("chunks"))
    n_shards = F.lit(max(1, math.ceil(n_pairs / SHARD_PAIRS)))
    shard = F.pmod(F.xxhash64("probe", "chunk"), n_shards).alias("shard")
    dealt = (pairs.join(counts, "probe").withColumn("chunk", F.pmod(F.xxhash64("sig"), F.col("chunks")))
             .select("sig", "probe", "chunk", shard))
    probes = (counts.select(F.col("probe").alias("sig"), "probe", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
              .select("sig", "probe", "chunk", shard))
    # a pair or two for each class: the sets stay where they are while the pairs are few
    met = sets.join(beside(dealt.unionByName(probes), 2 * n_pairs), "sig")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (probe, _), own in part.groupby(["probe", "chunk"], sort=False):
            is_probe = own["sig"] == probe
            if not is_probe.any():
                continue
            mine, others = own[is_probe].iloc[0], own[~is_probe]
            sigs = others["sig"].tolist()
            found = overlaps_enough(np.asarray(mine["tokens"], np.int64), int(mine["n"]), others["n"].tolist(),
                                    [np.asarray(t, np.int64) for t in others["tokens"]])
            out += [(probe, sigs[k]) for k in found]
        return pd.DataFrame(out, columns=["probe", "sig"], dtype="int64")

    links = met.groupBy("shard").applyInPandas(compare, "probe long, sig long")
    return scratch.write(links, f"{name}-links")


def connect(scratch: Scratch, name: str, labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (sig, label) after the links (probe, sig) join components: the least label of each."""
    ends = (links.join(labels.withColumnsRenamed({"sig": "probe", "label": "a"}), "probe")
            .join(labels.withColumnRenamed("label", "b"), "sig").where("a <> b"))
    edges = ends.select("a", "b").unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = scratch.write(edges, f"{name}-edges")
    # components of the old labels: each takes the least label near it, then that label's own, until nothing changes
    roots = edges.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    step = 0
    while True:
        near = (edges.join(roots.withColumnsRenamed({"node": "b", "root": "near"}), "b")
                .groupBy("a").agg(F.min("near").alias("near")))
        lower = (roots.join(near, roots["node"] == near["a"], "left")
                 .select("node", F.col("root").alias("was"), F.least("root", F.coalesce("near", "root")).alias("root")))
        lower = scratch.write(lower, f"{name}-lower-{step}")
        jump = lower.select(F.col("node").alias("at"), F.col("root").alias("jump"))
        new = (lower.join(jump, lower["root"] == jump["at"], "left")
               .select("node", "was", F.least("root", F.coalesce("jump", "root")).alias("root")))
        new = scratch.write(new, f"{name}-roots-{step}")
        changed = new.where("root <> was").limit(1).count()
        roots = new.select("node", "root")
        if not changed:
            break
        step += 1
    joined = labels.join(roots, labels["label"] == roots["node"], "left")
    return scratch.write(joined.select("sig", F.coalesce("root", "label").alias("label")), f"{name}-labels")


def _may_link(n: Column, place: Column, other_n: Column, other_place: Column) -> Column:
    """Whether sets that meet first at these places of their orders can overlap enough (sizes are bounded by it too)."""
    return (100 + PERCENT) * F.least(n - place, other_n - other_place) >= PERCENT * (n + other_n)


def link_classes(spark: SparkSession, scratch: Scratch, sets: DataFrame, rounds: int = LEADER_ROUNDS) -> DataFrame:
    """(sig, label): components of the classes under the exact links."""
    labels = scratch.write(sets.select("sig", F.col("sig").alias("label")), "labels")
    n_labels = labels.count()
    # n-grams of no other class come first in the order: they are not in ``tokens`` but take places
    alone = F.col("n") - F.size("tokens")
    prefix = F.size("tokens") - needed_share(F.col("n")) + 1
    holders = sets.select("sig", "n", alone.alias("alone"), F.posexplode(F.slice("tokens", F.lit(1), prefix)).alias("at", "token"))
    holders = scratch.write(holders.select("sig", "n", "alone", (F.col("alone") + F.col("at")).alias("place"), "token"), "holders")
    checked = None
    for turn in range(rounds + 1):
        now = holders.join(beside(labels, n_labels), "sig")
        # An n-gram whose holders are all in one component has nothing left to compare. The first leader is the
        # holder with the smallest share of n-grams of its own (the text that the others were made from, where there
        # is one); later leaders are drawn by hash.
        draw = F.col("alone") / F.col("n") if turn == 0 else F.lit(0.0)
        best = F.min(F.struct(draw.alias("share"), F.xxhash64("sig", F.lit(turn)).alias("draw"), F.col("sig").alias("leader"),
                              F.col("n").alias("leader_n"), F.col("place").alias("leader_place"),
                              F.col("label").alias("leader_label")))
        leaders = (now.groupBy("token").agg(best.alias("best"), F.min("label").alias("low"), F.max("label").alias("high"))
                   .where("low <> high").select("token", "best.*"))
        if turn < rounds:
            pairs = (now.join(leaders, "token").where("label <> leader_label")
                     .where(_may_link(F.col("n"), F.col("place"), F.col("leader_n"), F.col("leader_place")))
                     .groupBy("sig").agg(F.min(F.struct("share", "draw", "leader")).alias("best"))
                     .select(F.least("sig", "best.leader").alias("low"), F.greatest("sig", "best.leader").alias("high"),
                             F.col("best.leader").alias("probe"))
                     .groupBy("low", "high").agg(F.min("probe").alias("probe")))
        else:
            open_ = now.join(leaders.select("token"), "token", "left_semi")
            open_ = scratch.write(open_.select("token", "sig", "n", "place", "label"), "open")
            other = open_.select("token", F.col("sig").alias("probe"), F.col("n").alias("probe_n"),
                                 F.col("place").alias("probe_place"), F.col("label").alias("probe_label"))
            pairs = (open_.join(other, "token").where("probe < sig AND label <> probe_label")
                     .where(_may_link(F.col("n"), F.col("place"), F.col("probe_n"), F.col("probe_place")))
                     .select(F.col("probe").alias("low"), F.col("sig").alias("high"), "probe").distinct())
        if checked is not None:
            pairs = pairs.join(checked, ["low", "high"], "left_anti")
        pairs = scratch.write(pairs, f"round-{turn}")
        if pairs.isEmpty():
            if leaders.isEmpty():
                break
            continue
        done = pairs.select("low", "high")
        checked = done if checked is None else checked.unionByName(done)
        asked = pairs.select("probe", F.when(F.col("probe") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("sig"))
        links = verified_links(scratch, f"round-{turn}", asked, sets)
        if not links.isEmpty():
            labels = connect(scratch, f"round-{turn}", labels, links)
    return labels


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (least id reachable by links), class_sig (name of the row's set)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    members = scratch.write(set_signatures(docs, id_col, text_col), "members")
    total = members.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(1, math.ceil(total / BUCKET_NGRAMS))
    sets = scratch.write(linkable_sets(docs, members, n_buckets, text_col), "sets")
    labels = link_classes(spark, scratch, sets)
    labelled = (members.join(labels, "sig", "left")
                .withColumn("label", F.when(F.col("n") > 0, F.coalesce("label", "sig"))))
    least = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    return (labelled.join(least, "label", "left")
            .select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
                    F.col("sig").alias("class_sig")))
