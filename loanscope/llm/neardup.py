"""Near-duplicate documents by MinHash bands with sequential Bayesian verification.

1. Each document becomes its set of word shingles, a digest of the set, a MinHash
   signature and the keys of its bands. Documents with one digest form a class, and the
   class with the smallest document goes on.
2. Classes that share a band key are candidates. A bucket of m classes does not become
   m * m pairs. First its classes meet one pivot, and links found join components. Buckets
   whose classes all lie in one component are done, as classes in one component need no
   comparison. Other buckets that overlap make up an arena; there every class outside the
   largest component is compared with everyone, in blocks of bounded size inside tasks: first
   by signatures, then texts are sent to the blocks where they have a likely partner. Only
   links that join components come out. So no link between candidates is missed.
3. A pair's signatures are compared in batches. After each batch the posterior chance
   that the similarity reaches the threshold, from a uniform prior, is looked up; below
   the chosen miss probability the pair is dropped (Satuluri and Parthasarathy, 2012).
4. Survivors are compared on their full shingle sets.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.llm.components import contracted
from loanscope.llm.shingles import common_shingles, mixed, shingle_set
from loanscope.llm.workspace import Workspace

#: Hash functions of a signature.
HASHES = 192
#: Signature positions compared at a time.
BATCH = 16
#: Chance that a pair at the threshold shares no band, and that a batch drops such a pair.
MISS = 1e-6
#: Shingles hashed at once, to bound the memory of long texts.
SPAN = 2048

#: Classes of a block in which candidates meet, and bytes of their texts.
BLOCK, BLOCK_BYTES = 512, 8 << 20

_RULE = np.random.Generator(np.random.PCG64(77))
_FACTOR = _RULE.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFT = _RULE.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def bands_for(threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Rows and number of bands: the longest rows that keep the miss probability."""
    fitting = [
        (rows, HASHES // rows)
        for rows in range(1, 17)
        if (1 - threshold**rows) ** (HASHES // rows) <= miss
    ]
    if not fitting:
        raise ValueError(f"{HASHES} hashes are too few for similarity {threshold}")
    return fitting[-1]


def fewest_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For each number of batches, the matches below which the posterior drops a pair.

    With m of n positions equal and a uniform prior the similarity is Beta(m + 1, n - m + 1),
    and its chance to reach t is that of at most m successes in n + 1 trials of chance t.
    """
    fewest = []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        fewest.append(m)
    return fewest


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash signature of a set of shingles."""
    small = (shingles[:, 0] >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(small), SPAN):
        hashed = _FACTOR[:, None] * small[None, at : at + SPAN]
        hashed += _SHIFT[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, rows: int, bands: int) -> np.ndarray:
    used = least[: rows * bands].reshape(bands, rows).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + used[:, i])
    return key.view(np.int64)


SKETCH = "doc_id long, n_shingles long, digest binary, signature binary, bands array<bigint>"


def _sketch(size: int, rows: int, bands: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
            ("signature", pa.binary()), ("bands", pa.list_(pa.int64())),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column("text").to_pylist():
                found = shingle_set(text, size)
                if len(found):
                    least = signature(found)
                    made.append(
                        (
                            len(found), xxhash.xxh3_128_digest(found.tobytes()),
                            (least & np.uint32(0xFFFF)).astype(np.uint16).tobytes(),
                            band_keys(least, rows, bands),
                        )
                    )
                else:
                    made.append((0, None, None, None))
            columns = list(zip(*made, strict=True)) or [()] * 4
            arrays = [batch.column("doc_id")]
            arrays += [pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return sketch


def _likely(fewest: list[int]):
    """Pairs whose posterior stays above the miss probability after every batch."""
    needed = np.array(fewest)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES)
                for c in ("signature_a", "signature_b")
            ]
            open_ = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, np.int64)
            for i, least in enumerate(needed):
                part = slice(i * BATCH, (i + 1) * BATCH)
                matches[open_] += (sides[0][open_, part] == sides[1][open_, part]).sum(axis=1)
                open_ = open_[matches[open_] >= least]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(open_)) for c in ("a", "b")], names=["a", "b"]
            )

    return likely


def _linked(size: int, percent: int):
    """Pairs whose full shingle sets reach the threshold."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[int, np.ndarray] = OrderedDict()

        def shingles(key: int, text: str) -> np.ndarray:
            found = recent.pop(key, None)
            if found is None:
                found = shingle_set(text, size)
            recent[key] = found
            if len(recent) > 32:
                recent.popitem(last=False)
            return found

        for batch in batches:
            a = batch.column("a").to_pylist()
            keep = []
            for i in range(batch.num_rows):
                left = shingles(a[i], batch.column("text_a")[i].as_py())
                right = shingle_set(batch.column("text_b")[i].as_py(), size)
                keep.append(_similar(left, right, percent))
            kept = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(kept) for c in ("a", "b")], names=["a", "b"]
            )

    return linked


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than ASCII white space, A to Z lower-cased. Documents with
    100 * common >= percent * union of their shingle sets are linked; ``component_id`` is the
    smallest doc_id reachable and ``kept`` says whether it is the document's own. Documents
    without words (or with null text) have no shingles and link with nothing. Rows without
    doc_id take no part in links: their component is null and they are kept. Rows with one
    doc_id and different texts are told apart by text, and each counts as that document.
    Other columns are not read. An empty table gives no row.
    """
    spark = docs.sparkSession
    threshold = percent / 100
    rows, bands = bands_for(threshold)
    source = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    with Workspace(spark, "neardup") as work:
        sketches = work.table("sketches", source.mapInArrow(_sketch(shingle, rows, bands), SKETCH))
        usable = sketches.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
        classes = work.table("classes", usable.groupBy("digest").agg(F.min("doc_id").alias("rep")))
        # A class is joined through both columns, so a large group of copies spreads out.
        chosen = usable.join(
            classes.withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"], "left_semi"
        )
        chosen = chosen.dropDuplicates(["doc_id", "digest"])  # repeated rows
        labels = _components(work, source, chosen.withColumnRenamed("doc_id", "rep"), shingle, percent)

        smallest = labels.groupBy("root").agg(F.min("rep").alias("component_id"))
        named = labels.join(smallest, "root").select("rep", "component_id")
        classes = classes.join(named, "rep", "left").select(
            "digest", F.coalesce("component_id", "rep").alias("component_id")
        )
        result = sketches.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
        own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        own = F.when(F.col("doc_id").isNotNull(), own)
        return work.keep(
            "result",
            result.select(
                "doc_id", "n_shingles", own.alias("component_id"),
                F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
            ),
        )


def _components(
    work: Workspace, source: DataFrame, chosen: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """Columns rep and root of every class that shares a band with another."""
    fewest = fewest_matches(percent / 100)
    keys = chosen.select("rep", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = work.table("members", keys.join(shared, "key"))
    # A class that meets many others makes a good pivot: an original meets its copies.
    scores = members.groupBy("rep").agg(F.sum("n").alias("score"))
    members = members.select("key", "rep")
    signatures = work.table("signatures", chosen.select("rep", "signature").join(scores, "rep"))
    reps = signatures.select("rep", "score").distinct()
    texts = source.join(reps.select(F.col("rep").alias("doc_id")), "doc_id")
    length = F.octet_length("text").cast("long").alias("length")
    texts = work.table("texts", texts.select(F.col("doc_id").alias("rep"), "text", length))

    # First every class of a bucket meets the bucket's pivot.
    pivot = F.max_by("rep", F.struct("score", F.xxhash64("rep"))).alias("a")
    pivots = members.join(reps, "rep").groupBy("key").agg(pivot)
    pairs = members.join(pivots, "key").filter("a <> rep").select("a", F.col("rep").alias("b"))
    pairs = work.table("pairs", pairs.distinct())
    stars = work.table("stars", _verified(pairs, signatures, texts, fewest, shingle, percent))
    labels = _relabelled(work, reps.select("rep", F.col("rep").alias("root")), stars, "stars")

    # Then the classes of buckets that still lie in several components.
    placed = members.join(labels, "rep")
    first = placed.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.min("rep").alias("a")
    )
    open_ = placed.join(first.filter("low < high").select("key", "a"), "key")
    open_ = open_.select("a", F.col("rep").alias("b")).distinct()
    arenas = contracted(work, open_, "arenas")
    if arenas is None:
        return labels
    arenas = arenas.select(F.col("node").alias("rep"), F.col("root").alias("arena"))
    # Signatures say who has a likely partner in a block; only those texts are sent there.
    lengths = texts.groupBy("rep").agg(F.max("length").alias("length"))
    met = _blocks(work, arenas.join(labels, "rep").join(lengths, "rep"))
    signed = signatures.select("rep", "signature")
    likely = met.join(signed, "rep").groupBy("arena", "i", "j").applyInArrow(_partners(fewest), MET)
    rows = work.table("likely", likely).join(signed, "rep").join(texts.drop("length"), "rep")
    found = rows.groupBy("arena", "i", "j").applyInArrow(
        _meet(shingle, percent, fewest), "a long, b long"
    )
    return _relabelled(work, labels, work.table("found", found), "found")


def _relabelled(work: Workspace, labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Labels with the components joined that links between representatives connect."""
    ends = labels.select("rep", "root")
    joined = links.join(ends.toDF("a", "u"), "a").join(ends.toDF("b", "v"), "b")
    roots = contracted(work, joined.select(F.col("u").alias("a"), F.col("v").alias("b")), name)
    if roots is None:
        return labels
    moved = labels.join(roots.toDF("root", "to"), "root", "left")
    return work.table(f"{name}-labels", moved.select("rep", F.coalesce("to", "root").alias("root")))


def _blocks(work: Workspace, members: DataFrame) -> DataFrame:
    """Classes dealt to the blocks in which they meet.

    The largest component of an arena is settled within itself, so the pairs to compare are
    those of the rest with everyone. Both sides are cut into blocks of about ``BLOCK`` classes
    and at most about ``BLOCK_BYTES`` of text, and block i of everyone meets block j of the
    rest in one group. ``length`` is that of a class's text, which itself stays away.
    """
    members = work.table("arena-members", members)
    sizes = members.groupBy("arena", "root").agg(F.count("*").alias("n"), F.sum("length").alias("length"))
    largest = F.max(F.struct("n", "root", "length"))
    sizes = sizes.groupBy("arena").agg(
        largest.alias("main"), F.sum("n").alias("n"), F.sum("length").alias("length")
    )
    blocks = lambda n, length: F.ceil(F.greatest(n / BLOCK, length / BLOCK_BYTES))
    placed = members.drop("length").join(sizes, "arena").select(
        "arena", "rep", "root", F.col("main.root").alias("main"),
        blocks(F.col("n"), F.col("length")).alias("across"),
        blocks(F.col("n") - F.col("main.n"), F.col("length") - F.col("main.length")).alias("down"),
    )
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    everyone = placed.select(
        "arena", own("across").alias("i"), every("down").alias("j"), "rep", "root", F.lit(False).alias("rest")
    )
    rest = placed.filter("root <> main").select(
        "arena", every("across").alias("i"), own("down").alias("j"), "rep", "root", F.lit(True).alias("rest")
    )
    return everyone.unionByName(rest)


MET = "arena long, i long, j long, rep long, root long, rest boolean"


def _partners(fewest: list[int]):
    """The rows of a block that have a likely partner in another component."""

    def partners(table: pa.Table) -> pa.Table:
        root, rest = table.column("root").to_numpy(), table.column("rest").to_numpy()
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16)
        signature = signature.reshape(-1, HASHES)
        everyone, found = np.flatnonzero(~rest), np.zeros(len(root), bool)
        for x in np.flatnonzero(rest):
            open_, _ = _open(signature, x, everyone[root[everyone] != root[x]], fewest)
            found[open_] = True
            found[x] = len(open_) > 0
        return table.drop_columns("signature").filter(pa.array(found)).select([c.split(" ")[0] for c in MET.split(", ")])

    return partners


def _open(signature: np.ndarray, x: int, others: np.ndarray, fewest: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Those of the others that the posterior leaves as partners of x, and their matches."""
    matches = np.zeros(len(others), np.int64)
    for i, least in enumerate(fewest):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches += (signature[others, part] == signature[x, part]).sum(axis=1)
        likely = matches >= least
        others, matches = others[likely], matches[likely]
        if not len(others):
            break
    return others, matches


def _meet(size: int, percent: int, fewest: list[int]):
    """Compares the rest of an arena with a block of everyone; links that join components."""

    def meet(table: pa.Table) -> pa.Table:
        rep = table.column("rep").to_numpy()
        root = table.column("root").to_numpy()
        rest = table.column("rest").to_numpy()
        text = table.column("text")
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16)
        signature = signature.reshape(-1, HASHES)
        sets: dict[int, np.ndarray] = {}

        def shingles(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingle_set(text[row].as_py(), size)
            return sets[row]

        label = root.copy()  # of the components as far as this block knows them
        everyone = np.flatnonzero(~rest)
        links = []
        for x in np.flatnonzero(rest):
            open_, matches = _open(signature, x, everyone[label[everyone] != label[x]], fewest)
            for y in open_[np.argsort(-matches, kind="stable")]:
                if label[y] != label[x] and _similar(shingles(x), shingles(y), percent):
                    links.append((int(rep[x]), int(rep[y])))
                    label[label == label[y]] = label[x]
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return meet


def _similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    small, large = sorted((left, right), key=len)
    if 100 * len(small) < percent * len(large):
        return False
    common = common_shingles(small, large)
    return 100 * common >= percent * (len(left) + len(right) - common)


def _verified(
    pairs: DataFrame, signatures: DataFrame, texts: DataFrame, fewest: list[int], shingle: int, percent: int
) -> DataFrame:
    """The linked ones among pairs of classes ``a``, ``b``."""
    side = lambda table, value, name: table.select(
        F.col("rep").alias(name), F.col(value).alias(f"{value}_{name}")
    )
    signed = pairs.join(side(signatures, "signature", "b"), "b").join(
        side(signatures, "signature", "a"), "a"
    )
    likely = signed.mapInArrow(_likely(fewest), "a long, b long")
    full = likely.join(side(texts, "text", "b"), "b").join(side(texts, "text", "a"), "a")
    return full.mapInArrow(_linked(shingle, percent), "a long, b long").distinct()
