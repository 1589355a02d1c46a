"""PII normalisation and hashing as native column expressions.

All of it stays inside whole-stage codegen: regex, lower, substring and
``sha2`` are JVM built-ins, so a billion rows cost no Python at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_DDI, EMAIL_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c) -> Column:
    """Strip leading/trailing Unicode whitespace (Spark's ``trim`` strips only spaces)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def nonblank(c) -> Column:
    """NULL for NULL or empty text: the truthiness test payload code applies."""
    c = _col(c)
    return F.when(c != F.lit(""), c)


def normalize_email(c) -> Column:
    """Trimmed, lower-cased address; NULL unless it looks like local@domain.tld."""
    e = F.lower(utrim(c))
    return F.when(e.rlike("(?U)" + EMAIL_PATTERN), e)


def normalize_phone(c, ddi: str = DEFAULT_DDI) -> Column:
    """E.164 text (``+<ddi><digits>``) or NULL when the number cannot be inferred.

    Digits only; one leading ``00`` dropped; kept as is when it already starts
    with the country code and has at least 12 digits; 10 or 11 digits get the
    country code; anything else is NULL.
    """
    digits = F.regexp_replace(F.regexp_replace(_col(c), r"(?U)\D", ""), "^00", "")
    n = F.length(digits)
    e164 = (F.when(digits.startswith(ddi) & (n >= 12), digits)
            .when(n.isin(10, 11), F.concat(F.lit(ddi), digits)))
    return F.concat(F.lit("+"), e164)


def sha256_hex(c) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text."""
    return F.sha2(_col(c), 256)


def hash_email(c) -> Column:
    """Normalise then hash; NULL when the address is not normalisable."""
    return sha256_hex(normalize_email(c))


def hash_phone(c, ddi: str = DEFAULT_DDI) -> Column:
    """Normalise then hash; NULL when the number is not normalisable."""
    return sha256_hex(normalize_phone(c, ddi))


#: What looks like an address or a phone number in running text.
EMAIL_IN_TEXT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
#: The same matches in one pass over the text: an address starts where a run of
#: its characters starts, or where the last address ended, and gives nothing back.
EMAIL_SCAN = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
PHONE_IN_TEXT = r"\+?[0-9][0-9 ().-]{8,18}[0-9]"


def contacts(docs: DataFrame) -> DataFrame:
    """Every address and phone number in ``text``, normalised and hashed: one
    row per occurrence, with the text as found."""
    def found(pattern: str, kind: str) -> Column:
        return F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)),
                           lambda x: F.struct(F.lit(kind).alias("tipo"), x.alias("bruto")))
    rows = docs.select("doc_id", F.explode(F.concat(found(EMAIL_SCAN, "email"), found(PHONE_IN_TEXT, "fone"))).alias("c"))
    normal = F.when(F.col("c.tipo") == "email", normalize_email(F.col("c.bruto"))).otherwise(
        normalize_phone(F.col("c.bruto")))
    return rows.select("doc_id", "c.tipo", "c.bruto", normal.alias("normalizado")).withColumn(
        "hash", sha256_hex("normalizado"))
