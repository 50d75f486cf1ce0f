"""Names, keys, labels and row formats."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions.text import extension


def fill(template: str, *values: Column) -> Column:
    """``template`` with its ``%s`` places taken by ``values``.

    A plain concatenation: ``format_string`` runs Java's formatter per row.
    """
    first, *rest = template.split("%s")
    if len(rest) != len(values):
        raise ValueError(f"{len(values)} values for {len(rest)} places")
    pieces = [F.lit(first)]
    for value, piece in zip(values, rest):
        pieces += [value.cast("string"), F.lit(piece)]
    return F.concat(*pieces)


def two_digits(n: Column) -> Column:
    """At least two digits, wider from 100 on (``lpad`` would cut those)."""
    digits = n.cast("string")
    return F.when(n < 10, F.concat(F.lit("0"), digits)).otherwise(digits)


def unit_filename(n: Column) -> Column:
    return fill(fixed.UNIT_FILE, two_digits(n))


def untitled(n: Column) -> Column:
    return fill(fixed.UNTITLED_UNIT, two_digits(n))


def original_key(user_id: Column, job_id: Column, filename: Column) -> Column:
    """Key of an uploaded file; the extension keeps its case."""
    return fill("originals/%s/%s%s", user_id, job_id, extension(filename))


def bundle_key(user_id: Column, job_id: Column) -> Column:
    return fill("bundles/%s/%s.zip", user_id, job_id)


def download_name(job_id: Column) -> Column:
    return fill("bundle_%s.zip", F.left(job_id, F.lit(8)))


def log_row(created_at: Column, step: Column, status: Column, message: Column) -> Column:
    clock = F.date_format(created_at, fixed.LOG_TIME_FORMAT)
    return fill("| %s | %s | %s | %s |", clock, step, status, message)


def hashed_id(*parts: Column) -> Column:
    """A replay-safe id in UUID layout, from what identifies the row."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.regexp_replace(
        digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})\z", "$1-$2-$3-$4-$5"
    )


def canonical_id(text: Column) -> Column:
    """Lower-case hyphenated UUID from any accepted spelling (plain, 32 hex
    digits, braces, ``urn:uuid:``); null if it is none."""
    digits = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    low = F.lower(text)
    return (
        F.when(low.rlike(rf"^(urn:uuid:)?{digits}\z"), F.right(low, F.lit(36)))
        .when(low.rlike(rf"^\{{{digits}\}}\z"), F.substring(low, 2, 36))
        .when(
            low.rlike(r"^[0-9a-f]{32}\z"),
            F.regexp_replace(low, r"^(.{8})(.{4})(.{4})(.{4})(.{12})\z", "$1-$2-$3-$4-$5"),
        )
    )


def state_label(status: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in fixed.STATE_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, status), status)
