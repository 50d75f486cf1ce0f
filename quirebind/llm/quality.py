"""Quality rules by weak supervision.

Each rule looks at one document and votes good (+1), bad (-1) or abstains (0).
Votes are taken to be independent given the true class.  Expectation-
maximisation estimates, without labels, how reliable each rule is on either
class; the posterior probability of the good class then replaces a filter that
all rules must pass.

The votes of all documents reach the driver only as counts per vote pattern.
There are at most ``3 ** len(RULES)`` patterns, however many documents there
are.  The texts are read once; a document's verdict is a look-up of its pattern.

Defined cases: null, empty and blank texts have no words, fail the base checks
and are not kept; repeated rows each get the verdict of their text; an empty
table gives an empty result; further columns, whatever their names, are carried
along untouched by ``rated`` and dropped by ``quality_report``.
"""

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from quirebind.llm.words import named, own_prefix, words
from quirebind.session import settle, small_batches

MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"

# --- fixed values: frequent function words of the languages --------------------
FUNCTION_WORDS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "auf das dem den der des die ein eine einer im in ist mit nicht sich und von zu "
    "au aux dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "al como con de del el en es la las los no para por que se su un una y".split()
)
# --- end of fixed values --------------------------------------------------------

PREFIX = "_q_"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: One vote per rule: the measure, good if on its good side, bad if on its bad side.
RULES = [
    "length", "repetition", "symbols", "lines", "word_length", "function_words", "capitals",
    "sentences", "letters",
]


def repeated_words(tokens: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more.

    Windows get exact numbers by doubling: two neighbours of length n with the
    same pair of numbers are the same words of length 2 n.
    """
    n = len(tokens) - window + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int64, len(tokens))
    length, built, have = 1, None, 0
    rest = window
    while rest:
        if rest & 1:
            if built is None:
                built, have = ids, length
            else:
                m = min(len(built), len(ids) - have)
                built = _numbers(built[:m], ids[have : have + m])
                have += length
        rest >>= 1
        if rest:
            ids = _numbers(ids[:-length], ids[length:])
            length *= 2
    grams = built[:n]
    _, inverse, count = np.unique(grams, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(tokens) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _numbers(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    pair = left * (int(right.max(initial=0)) + 1) + right
    return np.unique(pair, return_inverse=True)[1].astype(np.int64)


def measures(text: str | None) -> tuple[list[int], dict[str, float]]:
    """The base counts and what the rules look at."""
    tokens = words(text)
    n = len(tokens)
    seen: set[str] = set()
    lines = dup = ended = 0
    for line in (text or "").split("\n"):
        bare = line.strip("\x20\t\n\v\f\r")
        if not bare:
            continue
        lines += 1
        ended += bare[-1] in ".!?:;\"'”»…"
        if line in seen:
            dup += 1
        seen.add(line)
    chars = sum(map(len, tokens))
    symbols = sum(map((text or "").count, SYMBOLS))
    repeat = repeated_words(tokens)
    most = max(1, n)
    known = sum(t in FUNCTION_WORDS for t in tokens)
    return [n, chars, symbols, dup, repeat], {
        "length": n,
        "repetition": repeat / most,
        "symbols": symbols / most,
        "lines": dup / max(1, lines),
        "word_length": chars / most,
        "function_words": known / most,
        "capitals": sum(map(str.isupper, tokens)) / most,
        "sentences": ended / max(1, lines),
        "letters": sum(any(map(str.isalpha, t)) for t in tokens) / most,
    }


def _low(x: float, good: float, bad: float) -> int:
    return 1 if x <= good else -1 if x > bad else 0


def _high(x: float, good: float, bad: float) -> int:
    return 1 if x >= good else -1 if x < bad else 0


def votes(m: Mapping[str, float]) -> list[int]:
    """A vote per rule of ``RULES``; all abstain but the length where there is
    no word."""
    if not m["length"]:
        return [-1] + [0] * (len(RULES) - 1)
    return [
        _high(m["length"], 50, MIN_WORDS),
        _low(m["repetition"], 0.1, 0.3),
        _low(m["symbols"], 0.02, 0.1),
        _low(m["lines"], 0.1, 0.3),
        1 if 3 <= m["word_length"] <= 10 else -1 if not 2 <= m["word_length"] <= 14 else 0,
        _high(m["function_words"], 0.1, 0.03),
        _low(m["capitals"], 0.2, 0.5),
        _high(m["sentences"], 0.7, 0.2),
        _high(m["letters"], 0.8, 0.6),
    ]


def pattern_of(v: list[int]) -> int:
    """Votes as a number of base three."""
    return sum((x + 1) * 3**i for i, x in enumerate(v))


def votes_of(pattern: int) -> list[int]:
    return [pattern // 3**i % 3 - 1 for i in range(len(RULES))]


def measured(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Base counts (named with ``own_prefix``) and vote pattern next to the columns ``carry``."""
    p = own_prefix(carry, PREFIX)
    fields = [StructField(f"{p}{c}", LongType()) for c in BASE]
    fields += [StructField(f"{p}base_failed", BooleanType()), StructField(f"{p}pattern", IntegerType())]
    schema = StructType([docs.schema[c] for c in carry] + fields)
    # Tasks see columns by number: the map takes no names with dots.
    sent = carry if "text" in carry else [*carry, "text"]  # a carried text goes there once
    at = sent.index("text")
    rows = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(named(sent))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = []
            patterns, failed = [], []
            for text in batch.column(at):
                base, m = measures(text.as_py())
                counts.append(base)
                patterns.append(pattern_of(votes(m)))
                failed.append(base[0] < MIN_WORDS or 100 * base[4] > REPEAT_PERCENT * base[0])
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] or [
                pa.array([], pa.int64()) for _ in BASE
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(carry)], *columns, pa.array(failed, pa.bool_()),
                 pa.array(patterns, pa.int32())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def fit(counts: Mapping[int, int], rounds: int = 60) -> dict[int, float]:
    """The posterior probability of the good class per vote pattern.

    ``counts`` has the documents of each pattern.  A rule has two reliabilities:
    how often its vote is right on good and on bad documents.  Bad documents are
    bad in different ways, so a rule may miss most of them; it only has to cast
    bad votes more often there than on good ones.  Priors, in shares of the data
    so that size does not matter, say which class is the good one.
    """
    if not counts:
        return {}
    patterns = np.array([votes_of(p) for p in counts])
    weight = np.array([counts[p] for p in counts], float)
    weight /= weight.sum()
    good, bad = (patterns == 1).astype(float), (patterns == -1).astype(float)
    prior = np.array([[0.98], [0.3]])
    hit = np.repeat(prior, len(RULES), axis=1)  # P(vote is right | class good, bad)
    share = 0.8
    strength = 0.02  # the prior's weight against all documents
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-_log_odds(good, bad, hit, share)))
        share = (weight @ p + strength * 0.8) / (1 + strength)
        for k, (q, right, wrong) in enumerate(((p, good, bad), (1 - p, bad, good))):
            up, down = (weight * q) @ right, (weight * q) @ wrong
            hit[k] = (up + prior[k] * strength) / (up + down + strength)
        hit[0] = hit[0].clip(0.8, 0.999)
        hit[1] = np.maximum(hit[1], 2 * (1 - hit[0])).clip(0.01, 0.99)
    p = 1 / (1 + np.exp(-_log_odds(good, bad, hit, share)))
    return dict(zip(counts, p.tolist(), strict=True))


def _log_odds(good: np.ndarray, bad: np.ndarray, hit: np.ndarray, share: float) -> np.ndarray:
    up = np.log(hit[0]) - np.log(1 - hit[1])
    down = np.log(1 - hit[0]) - np.log(hit[1])
    return math.log(share / (1 - share)) + good @ up + bad @ down


def rated(docs: DataFrame, least: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all of ``docs``) with base counts, base_failed, quality
    (posterior) and kept, named with ``own_prefix(carry, PREFIX)``.  They are written
    once, to the shared folder; texts are not read again."""
    carry = docs.columns if carry is None else carry
    p = own_prefix(carry, PREFIX)
    with small_batches(docs.sparkSession):
        known = settle(measured(docs, carry))
    counts = {r[0]: r[1] for r in known.groupBy(f"{p}pattern").count().collect()}  # 3^9 at most
    table = fit(counts)
    quality = F.lit(0.0)
    if table:
        pairs = [F.lit(x) for row in sorted(table.items()) for x in row]
        quality = F.coalesce(F.create_map(*pairs)[F.col(f"{p}pattern")], F.lit(0.0))
    return known.withColumn(f"{p}quality", quality).withColumn(
        f"{p}kept", ~F.col(f"{p}base_failed") & (F.col(f"{p}quality") >= least)
    )


def quality_report(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """One row per document: base counts, verdict and posterior probability."""
    rows = rated(docs, least, ["doc_id"])
    return rows.select(
        "doc_id", *[
            F.col(f"{PREFIX}{c}").alias(c) for c in [*BASE, "base_failed", "kept", "quality"]
        ],
    )


def keep_good(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that are kept, with their own columns."""
    good = rated(docs, least).filter(F.col(f"{own_prefix(docs.columns, PREFIX)}kept"))
    return good.select(*named(docs.columns))
