"""Quality classifier from weak labels.

Overlapping labellers vote on documents: heuristics on the text (each says "bad" or stays
silent) and a table of human labels, which covers part of the documents. Expectation-
maximisation estimates how often each labeller votes how for good and for bad documents,
without ground truth (Dawid and Skene, 1979; silence counts as a vote of its own), and with
that the chance that a document is bad given its votes. Documents differ in few patterns of
votes, so the estimate runs on pattern counts over all documents.

The posteriors then train a linear scorer on hashed features of the text, on a bounded
sample of documents with at least one vote. It reads every document, so what humans marked
in some of them (rude words, say) is found in all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.llm.shingles import mixed, spans, text_bytes, words_of
from loanscope.llm.workspace import Workspace

#: Documents that train the scorer, at most about this many.
TRAIN_DOCS = 20_000
#: Hashed features, as a power of two.
FEATURE_BITS = 18
#: Passes over the training documents, documents per step, step size, weight decay.
EPOCHS, STEP_DOCS, RATE, DECAY = 20, 64, 0.2, 5e-4
#: A feature counts if it is seen so often and lies so far from chance, in standard deviations.
LEAST_SEEN, SIGMAS = 5, 4.0
#: Documents whose chance of being bad exceeds this are rejected.
REJECT_ABOVE = 0.4

#: How much less often than chance a labeller errs, and the documents that this belief is worth.
ERROR, BELIEF_DOCS = 0.02, 50
#: How often a trusted labeller errs.
TRUSTED_ERROR = 0.002

SILENT, GOOD, BAD = 0, 1, 2
HEURISTICS = ("symbols", "capitals", "repeated_words", "few_words", "bare_symbols")

_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_MARK = np.array([b < 128 and not chr(b).isalnum() and not chr(b).isspace() for b in range(256)])


def measures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The heuristics' shares, in their order, and the hashed features of a text."""
    data = text_bytes(text)
    counts = np.zeros(8)  # words, marked, bare, repeated, upper, letters, distinct, -
    features, previous = [], np.zeros(0, np.uint64)
    for span in spans(data):
        words = words_of(span)
        start, end = words.start, words.end
        if not len(start):
            continue
        whole = words.hashes()
        mark = _MARK[span]
        letters = np.concatenate([[0], np.cumsum(_LETTER[span])])
        bare = letters[end] == letters[start]
        marked = mark[end - 1] & mark[np.maximum(end - 2, start)] & (end - start > 2)
        following = np.concatenate([previous[-1:], whole])
        counts[:6] += (
            len(whole), marked.sum(), bare.sum(), (following[1:] == following[:-1]).sum(),
            _UPPER[span].sum(), letters[-1],
        )
        previous = whole
        parts = [whole]
        # Beginnings and ends of words, so that unseen words share features with seen ones.
        for width in (4, 5):
            parts.append(words.hashes(start, np.minimum(start + width, end)) + np.uint64(width))
        parts.append(words.hashes(np.maximum(end - 3, start), end) + np.uint64(99))
        features.append(np.unique(np.concatenate(parts)))
    found = np.zeros(0, np.uint64)
    if features:  # those of one stretch are distinct already
        found = features[0] if len(features) == 1 else np.unique(np.concatenate(features))
    total = max(counts[0], 1)
    # Distinct among the features: every distinct word has about one of its own.
    variety = len(found) / total if counts[0] >= 50 else 1.0
    shares = np.array(
        [counts[1] / total, counts[4] / max(counts[5], 1), counts[3] / total, variety, counts[2] / total]
    )
    return shares, (mixed(found) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def votes(shares: np.ndarray) -> np.ndarray:
    """Whether each heuristic calls the document bad."""
    symbols, capitals, repeated, variety, bare = shares
    bad = [symbols > 0.2, capitals > 0.4, repeated > 0.2, variety < 0.25, bare > 0.15]
    return np.where(bad, BAD, SILENT).astype(np.int8)


def _features(shares: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Distinct feature numbers: hashed ones, then one per vote, then one for all texts."""
    voted = np.flatnonzero(votes(shares) == BAD) + (1 << FEATURE_BITS)
    return np.concatenate([np.unique(hashed), voted, [FEATURES - 1]])


#: Hashed features, one for each heuristic, and one that every text has.
FEATURES = (1 << FEATURE_BITS) + len(HEURISTICS) + 1
#: Weights that know nothing: no document is bad.
NOTHING = np.zeros(FEATURES)
NOTHING[-1] = -100.0


# -- label model -----------------------------------------------------------------


def _beliefs(spoken: np.ndarray, kinds: int) -> np.ndarray:
    """Vote rates (labellers x classes x votes) before any document is seen.

    ``spoken`` are the labellers' overall rates. No labeller errs often; with a kind for each
    labeller, it calls about half of its own kind bad and others as often as all documents.
    """
    believed = np.repeat(spoken[:, None, :], 1 + kinds, axis=1)
    believed[:, 0, BAD] *= ERROR
    believed[:, 1:, GOOD] *= ERROR
    if kinds == 1:
        believed[:, 1, BAD] /= ERROR**0.5
    else:
        own = np.arange(kinds)
        believed[own, 1 + own, BAD] = believed[own, 1 + own, :BAD].sum(axis=1)
    return believed / believed.sum(axis=2, keepdims=True)


def posteriors(
    patterns: np.ndarray, counts: np.ndarray, trusted: int | None = None, rounds: int = 1000
) -> tuple[np.ndarray, np.ndarray]:
    """Chance of bad for each pattern of votes, and the labellers' vote rates.

    ``rates[l, y, v]`` is the share of documents of class y (0 good, 1 bad) for which
    labeller l votes v. The start is the majority of the votes that are not silent. The prior,
    that labellers seldom err, is worth ``BELIEF_DOCS`` documents of each class, whatever the
    size of the corpus, so estimates follow the data.

    ``trusted`` names a labeller, such as humans, that votes on documents of all classes alike
    and errs in ``TRUSTED_ERROR`` of its votes. With such an anchor there is one kind of bad
    document for each labeller, since kinds exclude each other and heuristics seldom agree; a
    kind that the trusted labeller calls good dies out. Without one, all bad documents are one
    class.
    """
    n, labellers = patterns.shape
    kinds = 1 if trusted is None else labellers
    ones = np.eye(3)[patterns]  # n x labellers x 3
    spoken = np.einsum("n,nlv->lv", counts, ones) + 1
    spoken /= spoken.sum(axis=1, keepdims=True)
    believed = BELIEF_DOCS * _beliefs(spoken, kinds)
    if trusted is not None:
        said, error = spoken[trusted, GOOD:].sum(), TRUSTED_ERROR
        known = np.array([[1 - said, said * (1 - error), said * error], *[[1 - said, said * error, said * (1 - error)]] * kinds])
    called = patterns == BAD
    many = called.sum(axis=1)
    likely = np.where(many > (patterns == GOOD).sum(axis=1), 0.9, 0.1)
    share = called[:, :kinds] / np.maximum(many, 1)[:, None] if kinds > 1 else np.ones((n, 1))
    share = np.where(share.sum(axis=1, keepdims=True) > 0, share, 1 / kinds)
    chance = np.column_stack([1 - likely, likely[:, None] * share])  # good, then each kind
    rates = believed
    for _ in range(rounds):
        weight = chance * counts[:, None]
        rates = np.einsum("ny,nlv->lyv", weight, ones) + believed
        rates /= rates.sum(axis=2, keepdims=True)
        if trusted is not None:
            rates[trusted] = known
        prior = (weight.sum(axis=0) + 1) / (counts.sum() + kinds + 1)
        log = np.log(prior) + np.einsum("nlv,lyv->ny", ones, np.log(rates))
        fresh = np.exp(log - log.max(axis=1, keepdims=True))
        fresh /= fresh.sum(axis=1, keepdims=True)
        done = np.abs(fresh - chance).max(initial=0) < 1e-6
        chance = fresh
        if done:
            break
    mixed_kinds = (chance[:, 1:] * counts[:, None]).sum(axis=0) + 1e-9
    bad = np.einsum("y,lyv->lv", mixed_kinds / mixed_kinds.sum(), rates[:, 1:])
    return 1 - chance[:, 0], np.stack([rates[:, 0], bad], axis=1)


# -- scorer ------------------------------------------------------------------------


def telling(rows: list[np.ndarray], chance: np.ndarray) -> np.ndarray:
    """Which features occur among bad documents more often than chance explains."""
    sizes = [len(r) for r in rows]
    index = np.concatenate([*rows, np.zeros(0, np.int64)])
    seen = np.bincount(index, minlength=FEATURES)
    bad = np.bincount(index, np.repeat(chance, sizes), minlength=FEATURES)
    share = np.repeat(chance, sizes).mean() if len(index) else 0.5
    spread = np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
    return (bad - seen * share > SIGMAS * spread) & (seen >= LEAST_SEEN)


def train(rows: list[np.ndarray], chance: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer on soft labels (AdaGrad, in a fixed order).

    Only telling features get a weight besides the constant. The many that say nothing would
    add up to noise in long texts, and plenty of good words must not hide a few rude ones.
    """
    told = telling(rows, chance)
    told[FEATURES - 1] = True
    used = np.flatnonzero(told)
    rows = [np.searchsorted(used, r[told[r]]) for r in rows]
    weights = np.zeros(len(used))
    squares = np.full(len(used), 1e-8)
    order = np.random.Generator(np.random.PCG64(5))
    for _ in range(EPOCHS):
        shuffled = order.permutation(len(rows))
        for at in range(0, len(rows), STEP_DOCS):
            step = shuffled[at : at + STEP_DOCS]
            sizes = [len(rows[i]) for i in step]
            index = np.concatenate([rows[i] for i in step])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            score = np.add.reduceat(weights[index], first)
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - chance[step]
            slope = np.bincount(index, np.repeat(error, sizes), minlength=len(used)) + DECAY * weights
            squares += slope * slope
            weights -= RATE * slope / np.sqrt(squares)
    every = np.zeros(FEATURES)
    every[used] = weights
    return every


def scored(weights: np.ndarray, text: str) -> float:
    """Chance of bad that the scorer gives a text."""
    index = _features(*measures(text))
    return float(1 / (1 + np.exp(-np.clip(weights[index].sum(), -30, 30))))


# -- on tables -----------------------------------------------------------------------


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [votes(measures(t)[0]).tolist() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(made, pa.list_(pa.int8()))], names=["doc_id", "votes"]
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [_features(*measures(t)).astype(np.int32) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("chance"), pa.array(made, pa.list_(pa.int32()))],
            names=["doc_id", "chance", "features"],
        )


def _fit(sample: pd.DataFrame) -> pd.DataFrame:
    sample = sample.sort_values(["doc_id", "chance"])
    weights = train([np.asarray(f, np.int64) for f in sample["features"]], sample["chance"].to_numpy())
    return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()]})


def fitted(
    docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, key: str = "doc_id", text: str = "text"
) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the scorer, and the vote rates of the labellers (humans last)."""
    source = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    human = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    human = human.agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), BAD).when(F.col("quality") == 1, GOOD))
        .cast("tinyint").alias("human")
    )
    with Workspace(docs.sparkSession, "quality") as work:
        voted = source.mapInArrow(_vote, "doc_id long, votes array<tinyint>").join(human, "doc_id", "left")
        every = F.concat("votes", F.array(F.coalesce("human", F.lit(SILENT).cast("tinyint"))))
        voted = work.table("votes", voted.select("doc_id", every.alias("votes")))
        # At most 3^6 patterns.
        seen = voted.groupBy("votes").count().collect()
        if not seen:
            return NOTHING, np.zeros((len(HEURISTICS) + 1, 2, 3))
        seen.sort(key=lambda r: r.votes)
        patterns = np.array([r.votes for r in seen])
        counts = np.array([r["count"] for r in seen], float)
        chance, rates = posteriors(patterns, counts, trusted=len(HEURISTICS))
        spoke = (patterns != SILENT).any(axis=1)
        share = min(1.0, train_docs / max(1.0, counts[spoke].sum()))
        known = {tuple(p): float(c) for p, c, s in zip(patterns.tolist(), chance, spoke, strict=True) if s}
        if not known:
            return NOTHING, rates

        # A sample by hash: any text of a chosen id takes part, whatever the order of rows.
        low = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)) < int(share * (1 << 30))
        lookup = F.create_map(
            *(F.lit(x) for p, c in known.items() for x in (",".join(map(str, p)), c))
        )
        pattern = F.array_join(F.col("votes").cast("array<string>"), ",")
        chosen = voted.filter(low).select("doc_id", lookup[pattern].alias("chance"))
        chosen = chosen.filter("chance IS NOT NULL").groupBy("doc_id").agg(F.avg("chance").alias("chance"))
        chosen = work.table("chosen", chosen)
        features = source.filter(low).join(chosen, "doc_id").mapInArrow(
            _extract, "doc_id long, chance double, features array<int>"
        )
        # One task trains, on a sample of bounded size.
        weights = features.groupBy().applyInPandas(_fit, "weights binary").collect()
        if not weights:
            return NOTHING, rates
        return np.frombuffer(weights[0].weights, np.float32).astype(float), rates


def bad_chance(weights: np.ndarray, text: Column) -> Column:
    """The scorer as a column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([scored(weights, t) for t in texts], dtype=float)

    return score(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """All columns of the documents with ``bad_chance`` and ``kept``.

    ``labels`` has doc_id, quality (0 or 1) and toxic (0 or 1); low quality or toxic is a vote
    for bad, otherwise quality 1 is one for good, and nulls or missing rows are silent. Repeated
    labels of an id count once, bad before good. A null text counts as empty. Rows without id are
    scored like others but train nothing. Without any vote nothing is
    learned, every chance is close to 0 and every document is kept. New columns replace input columns of the same name.
    """
    weights, _ = fitted(docs, labels, text=text, **options)
    rated = docs.withColumn("bad_chance", bad_chance(weights, F.col(text)))
    return rated.withColumn("kept", F.col("bad_chance") <= REJECT_ABOVE)
