"""Line filters for extracted text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import text


def lines(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Numbered lines of every text (from 1)."""
    found = docs.select(key, F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "line"))
    return found.select(key, (F.col("pos") + 1).alias("line_no"), "line")


def readable_lines(df: DataFrame, share: float = fixed.READABLE_SHARE) -> DataFrame:
    """Add the readability ratio of each line (trimmed) and whether it is kept."""
    trimmed = df.withColumn("line", text.trim_white(F.col("line")))
    return trimmed.withColumn("ratio", text.readable_ratio(F.col("line"))).withColumn(
        "kept", text.is_readable(F.col("line"), share)
    )


def clean_lines(
    docs: DataFrame, key: str = "doc_id", text_col: str = "text",
    share: float = fixed.READABLE_SHARE,
) -> DataFrame:
    """Each text reduced to its readable lines, one blank line apart."""
    return docs.select(key, text.clean_text(F.col(text_col), share).alias("text"))


def printable_lines(df: DataFrame) -> DataFrame:
    return df.withColumn("line", text.printable_only(F.col("line")))


def markup_paragraphs(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Paragraph text of a markup column, under the file's title."""
    filename = F.col("filename")
    title = F.concat(F.lit("# "), text.stem(filename), F.lit("\n\n"))
    body = text.or_else(text.markup_text(F.col("markup")), F.lit(fixed.EMPTY_MARKUP))
    return docs.select(key, F.concat(title, body).alias("text"))
