"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the matches of a few patterns.  Labelers (shape, checksum,
gazetteer, context, border) vote personal (+1), not personal (-1) or abstain (0)
on each.  Expectation-maximisation estimates how reliable each labeler is; the
posteriors then train a naive Bayes classifier on features of the span, which
decides on the candidates that the base patterns do not settle.

The driver sees counts per (kind, votes, features) only: at most
``6 * 3**5 * 3 * 6 * 4 * 3 * 3`` of them whatever the size of the corpus, some
hundred in practice.  Texts are read once.

Places count code points; ends are exclusive.  Per kind, matches are leftmost and
do not overlap; a match that fails its check is dropped without a retry.

Patterns begin at the start of a run of their first class and take runs
possessively, which finds what the plain patterns find in linear time and
without recursion.

Defined cases: a null text counts as empty and has no spans; repeated rows are
judged alike; an empty table gives an empty result; further columns are dropped
by ``pii_report`` and carried along by ``masked``.
"""

import math
from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quirebind.llm.words import named, own_prefix
from quirebind.session import settle

EMAIL, IP, CARD, PHONE, SECRET, NAME = range(6)
KINDS = ["email", "ip", "card", "phone", "secret", "name"]
BASE_KINDS = KINDS[:4]
PREFIX = "_p_"
LABELERS = ["shape", "checksum", "gazetteer", "context", "border"]
_BLOCK, _PIECE = 256, 64
_FAR = 1 << 40

# --- fixed values: patterns ----------------------------------------------------
_LOCAL = "[A-Za-z0-9._%+-]"
_HOST = "[A-Za-z0-9-]"
_KEY = "[A-Za-z0-9+/_-]"
PATTERNS = {
    EMAIL: rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    IP: r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    CARD: r"[0-9](?:[\x20-]?[0-9])++",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
    SECRET: rf"(?<!{_KEY})(?=[A-Za-z+/_-]*+[0-9]){_KEY}{{20,}}+",
    NAME: r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Madame|Monsieur|Señor|Señora)"
    r"\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?+",
}
#: A phone number without the plus sign; never a base span.
LOCAL_PHONE = r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

# --- fixed values: word lists --------------------------------------------------
DOMAINS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info"]
CALLING_CODES = ["1", "30", "31", "32", "33", "34", "39", "41", "43", "44", "49", "52", "61", "81", "86", "91"]
FIRST_NAMES = [
    "Anna", "Carlos", "David", "Hans", "James", "Jean", "John", "José", "Klaus", "Laura",
    "Marie", "Maria", "María", "Mary", "Michael", "Paul", "Peter", "Pierre", "Robert", "Sophie",
]
CUES = {
    EMAIL: "mail|contact|write|schreib|courriel|correo",
    IP: r"\bip\b|host|server|address|adresse",
    CARD: "card|visa|master|amex|payment|karte|carte|tarjeta",
    PHONE: "phone|call|tel|fax|mobil|ruf",
    SECRET: "token|secret|api.?key|password|passwd|auth",
    NAME: "name|signed|dear|author|von|par|por|by",
}
OTHERS = "version|order|invoice|isbn|sha|md5|commit|part no"
# --- end of fixed values -------------------------------------------------------


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, even where ``use`` has lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda s, x: s + x)


def _highest(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0).cast("bigint"))


def _before(values: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` (sum or maximum) of the numbers from 0 on that lie before each element.

    Every block is summed up once and the blocks before it are looked at as one, so that
    long arrays cost little more than their length."""
    blocks = F.sequence(F.lit(0), F.floor(F.size(values) / _BLOCK).cast("int"))
    each = F.transform(blocks, lambda j: of(F.slice(values, j * _BLOCK + 1, F.lit(_BLOCK))))
    heads = let(each, lambda e: F.transform(e, lambda _, j: of(F.slice(e, F.lit(1), j))))
    return let(heads, lambda h: F.transform(
        values,
        lambda _, i: of(F.array(
            F.get(h, F.floor(i / _BLOCK).cast("int")),
            of(F.slice(values, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)),
        )),
    ))


def matches(text: Column, pattern: str) -> Column:
    """Array of (value, start): the leftmost non-overlapping matches."""
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )
    size = lambda a, i: F.length(F.get(a, i)).cast("bigint")
    return let(parts, lambda p: let(
        F.transform(p["hits"], lambda h, i: F.length(h) + size(p["gaps"], i)),
        lambda lengths: let(_before(lengths, _total), lambda b: F.transform(
            p["hits"],
            lambda h, i: F.struct(
                h.alias("value"), (F.get(b, i) + size(p["gaps"], i)).alias("start")
            ),
        )),
    ))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check; null-safe for short ones."""
    each = F.split(F.reverse(digits), "")
    doubled = F.transform(each, lambda c, i: let(
        c.cast("int") * (1 + i % 2), lambda d: F.when(d > 9, d - 9).otherwise(d)
    ))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) % 10 == 0


def _octets_valid(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda o: let(
        F.regexp_replace(o, "^0+", ""),
        lambda d: (F.length(d) <= 3) & (F.coalesce(d.cast("int"), F.lit(0)) <= 255),
    ))


def _sign(good: Column, bad: Column | None = None) -> Column:
    bad = ~good if bad is None else bad
    return F.when(good, 1).when(bad, -1).otherwise(0)


def _any(words: Iterable[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def _checks(kind: int, value: Column, digits: Column) -> tuple[Column, Column, Column, Column]:
    """Base, shape, checksum and gazetteer votes of a kind."""
    n, yes, none = F.length(digits), F.lit(True), F.lit(0)
    if kind == EMAIL:
        return (
            yes, _sign(value.rlike(r"\.[A-Za-z]{2,12}$")), _sign(~value.rlike(r"\.\.|^\.|\.@")),
            _sign(value.rlike(rf"(?i)\.{_any(DOMAINS)}$"), F.lit(False)),
        )
    if kind == IP:
        valid = _octets_valid(value)
        return valid, _sign(F.length(value) <= 15), _sign(valid), _sign(
            F.lit(False), value.rlike(r"^(?:0|127|255)\.")
        )
    if kind == CARD:
        valid = luhn(digits)
        issuer = digits.rlike("^(?:4|5[1-5]|2[2-7]|3[0-9]|6)")
        return valid, _sign(n.isin(13, 14, 15, 16, 19), F.lit(False)), _sign(valid), _sign(issuer)
    if kind == PHONE:
        valid = n.between(9, 15)
        code = value.rlike(rf"^\+{_any(CALLING_CODES)}")
        return (
            value.startswith("+") & valid, _sign(valid), _sign(~value.rlike("--|\x20\x20")),
            _sign(code, F.lit(False)),
        )
    if kind == SECRET:
        mixed = value.rlike("[A-Za-z]") & (n >= 4)
        return F.lit(False), _sign(F.length(value) >= 24, F.lit(False)), _sign(mixed), none
    known = value.rlike(rf"\b{_any(FIRST_NAMES)}\b")
    return F.lit(False), F.lit(1), none, _sign(known, F.lit(False))


def _bucket(n: Column, edges: list[int]) -> Column:
    """Number of edges that ``n`` reaches."""
    out = F.lit(0)
    for e in edges:
        out = out + (n >= e).cast("int")
    return out


def _side(c: Column) -> Column:
    """Character class beside a span: 0 none or white, 1 letter or digit, 2 other."""
    return F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"[\p{L}\p{N}]"), 1).otherwise(2)


def _part(text: Column, start: Column, end: Column) -> Column:
    """The characters from ``start``, or the first, to before ``end``."""
    start = F.greatest(start, F.lit(0).cast("bigint"))
    return F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))


def _in_pieces(
    text: Column, spans: Column, since: Callable[[Column], Column],
    until: Callable[[Column], Column], use: Callable[[Column, Column, Column], Column],
) -> Column:
    """``use(span, piece of the text, place of the piece)`` of each span, in their order.

    To find a place in a text takes time with the place, so ``_PIECE`` spans at a time share
    a piece: from ``since`` of the first to ``until`` of the last."""
    blocks = F.when(F.size(spans) > 0, F.sequence(
        F.lit(0), F.floor((F.size(spans) - 1) / _PIECE).cast("int")
    )).otherwise(F.array().cast("array<int>"))
    cut = lambda s: F.struct(
        F.greatest(since(F.get(s, F.lit(0))), F.lit(0).cast("bigint")).alias("at"),
        _part(text, since(F.get(s, F.lit(0))), until(F.element_at(s, -1))).alias("piece"),
    )
    return F.flatten(F.transform(blocks, lambda j: let(
        F.slice(spans, j * _PIECE + 1, F.lit(_PIECE)), lambda s: let(
            cut(s), lambda c: F.transform(s, lambda x: use(x, c["piece"], c["at"]))
        ),
    )))


def _candidate(kind: int, hit: Column, piece: Column, at: Column) -> Column:
    value = hit["value"]
    length = F.length(value)
    end = hit["start"] + length
    around = F.struct(
        _digits(value).alias("digits"),
        _part(piece, hit["start"] - at - 24, hit["start"] - at).alias("left"),
        _part(piece, end - at, end - at + 1).alias("right"),
    )

    def row(a: Column) -> Column:
        base, shape, checksum, gazetteer = _checks(kind, value, a["digits"])
        cue = F.lower(a["left"])
        sides = _side(F.right(a["left"], F.lit(1))), _side(a["right"])
        return F.struct(
            hit["start"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
            base.alias("base"), shape.alias("shape"), checksum.alias("checksum"),
            gazetteer.alias("gazetteer"),
            _sign(cue.rlike(CUES[kind]), cue.rlike(OTHERS)).alias("context"),
            _sign((sides[0] != 1) & (sides[1] != 1)).alias("border"),
            (_bucket(length, [8, 12, 16, 20, 32]) + 6 * F.lit(kind)).alias("f_length"),
            (checksum + 1 + 3 * F.lit(kind)).alias("f_check"),
            (_bucket(F.floor(4 * F.length(a["digits"]) / length), [1, 2, 3]) + 4 * F.lit(kind))
            .alias("f_digits"),
            (sides[0] + 3 * sides[1]).alias("f_sides"),
            (_sign(cue.rlike(CUES[kind]), cue.rlike(OTHERS)) + 1 + 3 * F.lit(kind))
            .alias("f_context"),
        )

    return let(around, row)


def _located(text: Column, use: Callable[[Column, Column, Column], Column], hits: Column) -> Column:
    return _in_pieces(
        text, hits, lambda h: h["start"] - 24, lambda h: h["start"] + F.length(h["value"]) + 1, use
    )


FEATURES = {"f_length": 36, "f_check": 18, "f_digits": 24, "f_sides": 9, "f_context": 18}


def candidates(text: Column) -> Column:
    """All candidates of a text: arrays per kind in a row.  A cheap look for a
    character that each match must have comes first."""
    text = F.coalesce(text, F.lit(""))
    digit = text.rlike("[0-9]")
    found = [
        (EMAIL, PATTERNS[EMAIL], F.contains(text, F.lit("@")), None),
        (IP, PATTERNS[IP], digit & F.contains(text, F.lit(".")), None),
        (CARD, PATTERNS[CARD], digit, lambda h: F.length(_digits(h["value"])).between(12, 19)),
        (PHONE, PATTERNS[PHONE], F.contains(text, F.lit("+")), None),
        (PHONE, LOCAL_PHONE, digit, None),
        (SECRET, PATTERNS[SECRET], digit, None),
        (NAME, PATTERNS[NAME], text.rlike(PATTERNS[NAME]), None),
    ]
    nothing = F.array().cast("array<struct<value: string, start: bigint>>")
    arrays = []
    for kind, pattern, gate, keep in found:
        hits = F.when(gate, matches(text, pattern)).otherwise(nothing)
        hits = hits if keep is None else F.filter(hits, keep)
        arrays.append(let(hits, partial(_located, text, partial(_candidate, kind))))
    return F.flatten(F.array(*arrays))


def fit(rows: list[Row], rounds: int = 50) -> dict[str, list[float]]:
    """Feature weights (log odds) of the span classifier.

    First expectation-maximisation over the votes, with priors that take every
    labeler to be better than chance; then naive Bayes on its posteriors.
    """
    total = float(sum(r["n"] for r in rows)) or 1.0
    hit = [0.8] * len(LABELERS)
    share = 0.5
    soft = [0.5] * len(rows)
    for _ in range(rounds):
        for i, r in enumerate(rows):
            odds = math.log(share / (1 - share))
            for j, name in enumerate(LABELERS):
                odds += r[name] * math.log(hit[j] / (1 - hit[j]))
            soft[i] = 1 / (1 + math.exp(-odds))
        share = (sum(r["n"] * p for r, p in zip(rows, soft, strict=True)) + 0.05 * total) / (
            1.1 * total
        )
        share = min(0.95, max(0.05, share))
        for j, name in enumerate(LABELERS):
            right = said = 0.0
            for r, p in zip(rows, soft, strict=True):
                if r[name]:
                    said += r["n"]
                    right += r["n"] * (p if r[name] > 0 else 1 - p)
            hit[j] = (right + 0.8 * 0.05 * total) / (said + 0.05 * total)
            hit[j] = min(0.98, max(0.55, hit[j]))
    weights: dict[str, list[float]] = {}
    good = sum(r["n"] * p for r, p in zip(rows, soft, strict=True))
    for name, size in FEATURES.items():
        up, down = [1.0] * size, [1.0] * size
        for r, p in zip(rows, soft, strict=True):
            up[r[name]] += r["n"] * p
            down[r[name]] += r["n"] * (1 - p)
        u, d = sum(up), sum(down)
        weights[name] = [math.log(a / u) - math.log(b / d) for a, b in zip(up, down, strict=True)]
    weights["bias"] = [math.log((good + 1) / (total - good + 1))]
    return weights


def _model(known: DataFrame, found: str) -> dict[str, list[float]]:
    keys = [*LABELERS, *FEATURES]
    each = known.select(F.explode(found).alias("c")).select(*[F.col(f"c.{k}") for k in keys])
    return fit(each.groupBy(*keys).agg(F.count("*").alias("n")).collect())


def _accepted(c: Column, weights: dict[str, list[float]]) -> Column:
    score = F.lit(weights["bias"][0])
    for name in FEATURES:
        table = F.array(*[F.lit(w) for w in weights[name]])
        score = score + F.get(table, c[name])
    return (score > 0) & (c["checksum"] >= 0) & (c["border"] >= 0)


def _place(c: Column) -> Column:
    return F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))


def _united(places: Column) -> Column:
    """Of (start, kind, end, own) by start: all own ones, and those that overlap none of
    them, once each.

    An own one that begins earlier overlaps if the highest end before reaches that far, one
    that begins later if the next own start does; both are running maxima."""
    ends = F.transform(places, lambda s: F.when(s["own"], s["end"]).otherwise(0))
    starts = F.reverse(F.transform(places, lambda s: F.when(s["own"], _FAR - s["start"]).otherwise(0)))
    sides = F.struct(
        let(ends, lambda e: _before(e, _highest)).alias("before"),
        F.reverse(let(starts, lambda s: _before(s, _highest))).alias("after"),
    )
    free = let(sides, lambda b: F.filter(places, lambda s, i: s["own"] | (
        (F.get(b["before"], i) <= s["start"]) & (_FAR - F.get(b["after"], i) >= s["end"])
    )))
    return let(F.transform(free, _place), lambda all_: F.filter(
        all_, lambda s, i: (i == 0) | ~s.eqNullSafe(F.get(all_, i - 1))
    ))


def spans(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry`` with ``base`` and ``all``, named with ``own_prefix(carry,
    PREFIX)``: arrays of (start, kind, end) by start, then kind."""
    p = own_prefix(carry, PREFIX)
    found, columns = f"{p}found", named(carry)
    known = settle(docs.select(*columns, candidates(F.col("text")).alias(found)))
    weights = _model(known, found)
    base = F.array_sort(F.transform(F.filter(found, lambda c: c["base"]), _place))
    both = F.array_sort(F.transform(
        F.filter(found, lambda c: c["base"] | _accepted(c, weights)),
        lambda c: F.struct(*[c[k].alias(k) for k in ("start", "kind", "end")], c["base"].alias("own")),
    ))
    return known.select(*columns, base.alias(f"{p}base"), let(both, _united).alias(f"{p}all"))


def _listed(places: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(places, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """Per document: base counts, digest of the base spans, all spans as text."""
    count = lambda k: F.size(F.filter("_p_base", lambda s: s["kind"] == k)).cast("bigint")
    return spans(docs, ["doc_id"]).select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
        F.sha2(_listed(F.col("_p_base")), 256).alias("base_sha256"),
        _listed(F.col("_p_all")).alias("spans"),
    )


def _merged(places: Column) -> Column:
    """Spans that overlap made one, named after the first, with the ``last`` end before."""

    def of(ends: Column, before: Column) -> Column:
        heads = F.filter(
            F.transform(places, lambda s, i: F.struct(
                s["start"].alias("start"), s["kind"].alias("kind"), F.get(before, i).alias("last")
            )), lambda h: h["start"] >= h["last"],
        )
        return let(heads, lambda all_: F.transform(all_, lambda h, i: h.withField(
            "end", F.coalesce(F.get(all_, i + 1)["last"], F.array_max(ends))
        )))

    return let(F.transform(places, lambda s: s["end"]), lambda ends: let(
        _before(ends, _highest), lambda before: of(ends, before)
    ))


def masked(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets, and
    ``n_chars``, where there is one, made to fit."""
    rows = spans(docs, docs.columns)
    places = F.col(f"{own_prefix(docs.columns, PREFIX)}all")
    text = F.col("text")
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    cut = let(_merged(places), lambda m: F.concat(
        F.array_join(_in_pieces(
            text, m, lambda s: s["last"], lambda s: s["start"],
            lambda s, piece, at: F.concat(
                _part(piece, s["last"] - at, s["start"] - at), F.get(tags, s["kind"])
            ),
        ), ""),
        F.substr(text, (F.element_at(m, -1)["end"] + 1).cast("int")),
    ))
    clean = F.when(F.size(places) > 0, cut).otherwise(text)
    out = rows.withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*named(docs.columns))
