"""Text rules as Column expressions.

Two dialect points run through this module.  Sizes are bytes
(``octet_length``) except where a rule counts characters, and patterns spell
their classes out: Java's ``\\s`` holds the vertical tab, its ``.`` stops at
more than the newline, and its case folding has a Turkish i.
"""

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirebind import fixed

# Regex spellings of the trimmed class, with and without the newline.
_WHITE_INLINE = (
    r"\t\x0B\f\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
_WHITE = r"\n" + _WHITE_INLINE
# Blank characters a heading may use as a separator.
_BLANK = r"[\t\n\f\r ]"
_BLANK_INLINE = r"[\t\f\r ]"


# Characters looked at by the right trim of a long text.
_TAIL = 1024


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def trim_white(s: Column) -> Column:
    """Trim all Unicode white space from a short string."""
    return F.btrim(s, F.lit(fixed.WHITE))


def trim_white_left(s: Column) -> Column:
    return F.ltrim(s, F.lit(fixed.WHITE))


def trim_white_right(s: Column) -> Column:
    """Right trim for whole texts; ``s`` should be a stored column.

    The built-in trim with a character set keeps two integers per byte of its
    input, so it gets the last characters only.  A text that ends well (a look
    at its last bytes) is passed through; one whose last characters are all
    white is left to a regex.
    """
    ends_white = reduce(or_, [s.endswith(c) for c in fixed.WHITE])
    pattern = rf"(?<![{_WHITE}])[{_WHITE}]++\z"

    def cut(tail: Column) -> Column:
        kept = F.rtrim(tail, F.lit(fixed.WHITE))
        before = F.char_length(s) - F.char_length(tail)
        return F.when(
            (kept != "") | (before == 0), F.left(s, before + F.char_length(kept))
        ).otherwise(F.regexp_replace(s, pattern, ""))

    return F.when(ends_white, bind(F.right(s, F.lit(_TAIL)), cut)).otherwise(s)


def extension(filename: Column) -> Column:
    """Last dot of the last path element and what follows; '' if none."""
    return F.regexp_extract(filename, r"(\.[^./]*)\z", 1)


def stem(filename: Column) -> Column:
    keep = F.char_length(filename) - F.char_length(extension(filename))
    return F.left(filename, keep)


def first_line(s: Column) -> Column:
    return F.substring_index(s, "\n", 1)


# --- headings ---------------------------------------------------------------

def _any_case(word: str) -> str:
    """One class per letter.  The only fold outside a letter pair that the
    rules allow is the long s."""
    return "".join(
        "[{}{}{}]".format(c, c.upper(), "ſ" if c == "s" else "") for c in word
    )


_WORDS = "|".join(_any_case(w) for w in fixed.CHAPTER_WORDS)
_NUMBER = "[0-9]+|[" + fixed.ROMAN_LETTERS + fixed.ROMAN_LETTERS.lower() + "]+"
_LOW, _HIGH = fixed.NUMBERED_TITLE_RUNES

# A trimmed line, one pattern per heading form.
HASH_LINE = rf"^#+{_BLANK}+([^\n]+)"
CHAPTER_LINE = rf"^(?:{_WORDS}){_BLANK}+({_NUMBER})(?:[\t\n\f\r :-]+([^\n]*))?\z"
NUMBERED_LINE = (
    rf"^([0-9]+)\.{_BLANK}+([{fixed.HEADING_CAPITALS}][^\n]{{{_LOW},{_HIGH}}})\z"
)

# The newline in front of an untrimmed heading line, anywhere in a text.
# Everything before the title is possessive, so a failed attempt never walks
# back over a run of white space.
_LINE_END = rf"[{_WHITE_INLINE}]*+(?:\n|\z)"
HEADING_BREAK = (
    rf"\n(?=[{_WHITE_INLINE}]*+(?:"
    rf"#++{_BLANK_INLINE}[{_WHITE_INLINE}]*+[^{_WHITE}]"
    rf"|(?:{_WORDS}){_BLANK_INLINE}++(?:{_NUMBER.replace('+', '++')})(?:[\t\f\r :-]|{_LINE_END})"
    rf"|[0-9]++\.{_BLANK_INLINE}++[{fixed.HEADING_CAPITALS}]"
    rf"[^\n]{{{_LOW - 1},{_HIGH - 1}}}[^{_WHITE}]{_LINE_END}"
    rf"))"
)


def heading_kind(trimmed: Column) -> Column:
    """'hash', 'chapter', 'numbered', or null for an ordinary line."""
    return (
        F.when(trimmed.rlike(HASH_LINE), F.lit("hash"))
        .when(trimmed.rlike(CHAPTER_LINE), F.lit("chapter"))
        .when(trimmed.rlike(NUMBERED_LINE), F.lit("numbered"))
    )


def heading_title(trimmed: Column) -> Column:
    """Title of a trimmed heading line, null for an ordinary line."""
    sub = trim_white(F.regexp_extract(trimmed, CHAPTER_LINE, 2))
    chapter = F.concat(
        F.lit(fixed.CHAPTER_TITLE),
        F.regexp_extract(trimmed, CHAPTER_LINE, 1),
        F.when(sub != "", F.concat(F.lit(": "), sub)).otherwise(""),
    )
    numbered = F.concat(
        F.lit(fixed.SECTION_TITLE),
        F.regexp_extract(trimmed, NUMBERED_LINE, 1),
        F.lit(": "),
        F.regexp_extract(trimmed, NUMBERED_LINE, 2),
    )
    return (
        F.when(trimmed.rlike(HASH_LINE), trim_white(F.regexp_extract(trimmed, HASH_LINE, 1)))
        .when(trimmed.rlike(CHAPTER_LINE), chapter)
        .when(trimmed.rlike(NUMBERED_LINE), numbered)
    )


# --- cleaning ---------------------------------------------------------------

def readable_ratio(trimmed: Column) -> Column:
    """Share of readable characters in a trimmed string; 0 for a blank one.

    Counts what is left after deleting the readable ones: ``translate`` is a
    table look-up per character, many times faster than a regex class.
    """
    n = F.char_length(trimmed)
    rest = F.char_length(F.translate(trimmed, fixed.READABLE_RUNES, ""))
    return F.when(n > 0, (n - rest).cast("double") / n.cast("double")).otherwise(0.0)


def is_readable(trimmed: Column, share: float = fixed.READABLE_SHARE) -> Column:
    return (trimmed != "") & (readable_ratio(trimmed) >= share)


def clean_text(s: Column, share: float = fixed.READABLE_SHARE) -> Column:
    """Readable lines of a text, trimmed, one blank line apart."""
    lines = F.transform(F.split(s, "\n", -1), trim_white)
    return F.array_join(F.filter(lines, lambda x: is_readable(x, share)), "\n\n")


def printable_only(s: Column) -> Column:
    """Drop the control characters of a string, then trim it."""
    return trim_white(F.translate(s, fixed.DROPPED_RUNES, ""))


# --- markup -----------------------------------------------------------------

_PARAGRAPH_START = r"<(?:\w+:)?p(?=[\s/>])"
_INSIDE = """(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
_TAG = f"<{_INSIDE}>"
_EMPTY = r"""<(?![/!?])[^<>"']*+(?<=/)>"""
_ELEMENT = r"""<([^\s<>/!?"']++)(?:\s[^<>"']*+(?:"[^"<>]*+"[^<>"']*+)*+)?(?<!/)>[^<>]*+</\1\s*+>"""
_LAYERS = 6
_TEXT_ELEMENT = rf"(?s)<(?:\w+:)?t(?:\s{_INSIDE}(?<!/))?>(.*?)</(?:\w+:)?t\s*>"


_REFERENCE = r"(?s)^#(x[0-9A-Fa-f]+|[0-9]+);(.*)\z"
_LAST_CODE, _SURROGATES, _REPLACEMENT = 0x10FFFF, (0xD800, 0xDFFF), 0xFFFD
_CDATA, _CDATA_END = "<![CDATA[", "]]>"


def _code(digits: Column) -> Column:
    """Number of the digits of a numeric reference ('65' or 'x41'); a surrogate is
    the replacement character, null what is no character of a document."""
    number = F.when(
        digits.startswith("x"), F.conv(F.substr(digits, F.lit(2)), 16, 10)
    ).otherwise(digits).try_cast("decimal(38,0)")
    return bind(number, lambda n: F.when(
        n.between(*_SURROGATES), F.lit(_REPLACEMENT)
    ).when(
        n.isin(9, 10, 13) | n.between(32, 0xFFFD) | n.between(0x10000, _LAST_CODE),
        n.cast("bigint"),
    ))


def _is_reference(tail: Column) -> Column:
    """Whether the text behind an ampersand goes on as a sound reference."""
    named = F.lit(False)
    for name in fixed.ENTITIES:
        named = named | tail.startswith(f"{name};")
    digits = F.regexp_extract(tail, _REFERENCE, 1)
    return named | ((digits != "") & _code(digits).isNotNull())


def _decode_entities(s: Column) -> Column:
    """Named and numeric references, each decoded once."""

    def decoded(tail: Column) -> Column:
        code = _code(F.regexp_extract(tail, _REFERENCE, 1))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        found = F.when(
            tail.rlike(_REFERENCE) & code.isNotNull(),
            F.concat(char, F.regexp_extract(tail, _REFERENCE, 2)),
        )
        for name, char in fixed.ENTITIES.items():
            found = found.when(
                tail.startswith(f"{name};"),
                F.concat(F.lit(char), F.substr(tail, F.lit(len(name) + 2))),
            )
        return found.otherwise(F.concat(F.lit("&"), tail))

    def whole(x: Column) -> Column:
        pieces = F.split(x, "&", -1)
        tails = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded)
        return F.when(
            x.contains("&"), F.concat(pieces[0], F.array_join(tails, ""))
        ).otherwise(x)

    return bind(s, whole)


def _without_cdata(xml: Column) -> Column:
    """CDATA sections as escaped text; one without an end is lost with what follows
    up to the next."""

    def plain(piece: Column) -> Column:
        end = F.locate(_CDATA_END, piece)
        text = F.substr(piece, F.lit(1), end - 1)
        for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(char), F.lit(name))
        return F.when(end > 0, F.concat(text, F.substr(piece, end + 3))).otherwise("")

    def whole(x: Column) -> Column:
        pieces = F.split(x, r"<!\[CDATA\[", -1)
        tails = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), plain)
        return F.when(
            x.contains(_CDATA), F.concat(pieces[0], F.array_join(tails, ""))
        ).otherwise(x)

    return bind(xml, whole)


def _until_broken(xml: Column) -> Column:
    """What stands before the first reference that is none: readers stop there."""

    def cut(pieces: Column) -> Column:
        tails = F.slice(pieces, F.lit(2), F.size(pieces))
        bad = F.array_position(F.transform(tails, _is_reference), False)
        kept = F.when(bad > 0, F.slice(pieces, F.lit(1), bad.cast("int"))).otherwise(pieces)
        return F.array_join(kept, "&")

    return bind(xml, lambda x: F.when(
        x.contains("&"), bind(F.split(x, "&", -1), cut)
    ).otherwise(x))


_SUMMED = 64


def _running_sums(numbers: Column, depth: int = 2) -> Column:
    """Sums of an array's first entries, in blocks whose ends are summed in the same way.

    No array grows by an entry at a time: an entry costs half a block, and only the ends of
    the blocks of the last ``depth``, 4,096 entries each, are summed one by one.
    """
    zero, add = F.lit(0), lambda x, y: x + y
    upto = lambda s, i: F.reduce(F.slice(s, F.lit(1), i + 1), zero, add)
    if not depth:
        return bind(numbers, lambda a: F.transform(a, lambda x, i: upto(a, i)))

    def joined(blocks: Column, ends: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda s, k: F.transform(
            s, lambda x, i: F.coalesce(F.get(ends, k - 1), zero) + upto(s, i))))

    def summed(a: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(a), F.lit(_SUMMED))
        blocks = F.transform(starts, lambda b: F.slice(a, b, F.lit(_SUMMED)))
        return bind(blocks, lambda own: bind(
            _running_sums(F.transform(own, lambda s: F.reduce(s, zero, add)), depth - 1),
            lambda ends: joined(own, ends)))

    return bind(numbers, lambda a: F.when(F.size(a) > 0, summed(a)).otherwise(a))


def _first_mismatch(tags: Column) -> Column:
    """Place (from 0) of the first closing tag that closes nothing, or another element;
    null if there is none.

    An opener stands one level above what is around it, and what closes it on the same
    level.  As long as tags match, openers and closers of a level take turns: sorted by
    level and place, a closer's opener stands right in front of it.
    """
    step = F.transform(tags, lambda t: F.when(t.startswith("</"), -1).when(
        t.startswith("<?") | t.startswith("<!") | t.endswith("/>"), 0).otherwise(1))

    def paired(steps: Column, levels: Column) -> Column:
        placed = F.filter(F.transform(tags, lambda t, i: F.struct(
            F.when(F.get(steps, i) < 0, F.get(levels, i) + 1).otherwise(F.get(levels, i)).alias("level"),
            i.alias("place"), F.get(steps, i).alias("step"),
            F.substring_index(F.ltrim(F.translate(t, "</>\t\n\r", "      ")), " ", 1).alias("name"),
        )), lambda e: e["step"] != 0)
        return bind(F.sort_array(placed), lambda own: F.array_min(F.transform(
            own, lambda e, i: F.when((e["step"] < 0) & ~F.coalesce(
                (F.get(own, i - 1)["step"] > 0) & (F.get(own, i - 1)["level"] == e["level"])
                & (F.get(own, i - 1)["name"] == e["name"]), F.lit(False)), e["place"]))))

    return bind(step, lambda steps: bind(
        _running_sums(steps), lambda levels: paired(steps, levels)))


def _until_mismatched(xml: Column) -> Column:
    """What stands before the first closing tag that does not match: readers stop there,
    with the character data that they have read.  A text that ends inside an element, or
    inside a tag, is read up to there as well."""
    end = F.lit("</t>")

    def cut(x: Column, tags: Column, place: Column) -> Column:
        # The tags in front of it, and the text in front of each and behind the last.
        pieces = F.split(x, _TAG, -1)
        return bind(pieces, lambda p: F.concat(p[0], F.array_join(F.transform(
            F.slice(tags, F.lit(1), place), lambda t, i: F.concat(t, F.get(p, i + 1))), "")))

    def whole(x: Column) -> Column:
        exact = bind(F.regexp_extract_all(x, F.lit(_TAG), 0), lambda tags: bind(
            _first_mismatch(tags),
            lambda place: F.when(place.isNull(), x).otherwise(cut(x, tags, place))))
        # Elements without others inside go, layer by layer; if no closing tag is left, all
        # have matched, and there is nothing to find.
        rest = F.regexp_replace(x, _EMPTY, "")
        for _ in range(_LAYERS):
            rest = F.regexp_replace(rest, _ELEMENT, "")
        return F.when(rest.contains("</"), exact).otherwise(x)

    return F.concat(bind(F.regexp_replace(xml, r"<[^<>]*\z", ""), whole), end)


def markup_text(xml: Column) -> Column:
    """Text of word-processor markup: a blank line per ``p`` start, the
    character data of ``t`` elements, prefixes ignored.  Text in front of the
    first ``p`` is kept.

    A reference to no character ends the text, as it ends a reader's: what stands
    before its element is kept.  So does a closing tag that matches no open element; what
    stands before it is kept.
    """

    def flat(x: Column) -> Column:
        lines = F.replace(F.replace(x, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
        return F.when(x.contains("\r"), lines).otherwise(x)

    def plain(x: Column) -> Column:
        return F.when(x.contains("<!--"), F.regexp_replace(x, r"(?s)<!--.*?-->", "")).otherwise(x)

    def runs(p: Column) -> Column:
        text = F.array_join(F.regexp_extract_all(p, F.lit(_TEXT_ELEMENT), 1), "")
        return bind(text, lambda t: F.when(
            t.contains("<"), F.regexp_replace(t, _TAG, "")).otherwise(t))

    sound = _until_broken(_until_mismatched(_without_cdata(bind(bind(xml, flat), plain))))
    paragraphs = F.transform(
        F.split(sound, _PARAGRAPH_START, -1), lambda p: _decode_entities(runs(p))
    )
    return trim_white(F.array_join(paragraphs, "\n\n"))


def or_else(s: Column, other: Column) -> Column:
    """``other`` for a blank ``s``."""
    return bind(s, lambda x: F.when(x == "", other).otherwise(x))


# --- text of a document -----------------------------------------------------

def prepared_text(text: Column, filename: Column) -> Column:
    """Text that segmentation starts from, chosen by file extension."""
    ext = F.lower(extension(filename))
    title = F.concat(F.lit("# "), stem(filename), F.lit("\n\n"))
    return (
        F.when(
            ext == ".docx",
            F.concat(title, or_else(markup_text(text), F.lit(fixed.EMPTY_MARKUP))),
        )
        .when(
            ext == ".pdf",
            or_else(clean_text(text), F.concat(title, F.lit(fixed.EMPTY_SCAN))),
        )
        .when(trim_white_left(text).startswith("#"), text)
        .otherwise(F.concat(title, text))
    )
