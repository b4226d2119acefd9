"""Known licences by the digest of a canonical text.

A text is put into a canonical form: lower case, no copyright lines, one blank for any run of characters that are neither
letters nor digits, and one spelling where several are usual. Its SHA-256 is then hash-joined with the digests of known
licences. The whole text is looked up, and so is each of its lines, however long, since notices stand on a line of their
own in longer texts. All of it is SQL functions.

A copyright line starts, after comment marks, with the word copyright, with ``(c)`` or with ``©``, whatever follows. Two
kinds of lines that start so are sentences of a licence and stay: ``copyright`` before a word of ``SENTENCE``, as in
"copyright notice", and ``(c)`` in a line without a year and with a word of ``CONDITION``, as in the third item of a list.
A line that holds a copyright statement and a licence goes as a whole, so a licence after it in that line is not found.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.llm.license_texts import SPELLINGS, TEXTS
from martworks.llm.scratch import only

# Words that make a line a sentence about copyright, and words that make a line a condition.
SENTENCE = ("notices?|holders?|owners?|laws?|licen[sc]e[sd]?|interests?|statements?|protection|permission|ownership|"
            "infringements?|acts?|and|or|in|is|to|for|as")
CONDITION = ("you|your|must|shall|should|may|not|no|any|if|is|are|be|this|that|these|those|such|retain|include|provide|"
             "cause")


def copyright_line(letter: str, digit: str) -> str:
    """Expression of a line that states a copyright, with what may stand before the word."""
    other, end = rf"[^{letter}{digit}\n]*", rf"(?![{letter}{digit}])"
    return (rf"(^|\n){other}((\(c\){other})?copyright(?![{letter}])(?!\s+({SENTENCE}){end})|©|"
            rf"\(c\)(?=[^\n]*(19|20)[0-9][0-9]|{other}[{digit}]|(?![^\n]*(?<![{letter}{digit}])({CONDITION}){end})))[^\n]*")


COPYRIGHT_LINE = copyright_line(r"\p{L}", r"\p{N}")
# The narrower rule of the DuckDB query, which gives the same on the sf0.01 tables.
SQL_COPYRIGHT_LINE = r"(^|\n)[^\p{L}\p{N}\n]*(copyright|\(c\)|©)[ \t]*([0-9(©][^\n]*)"
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n")
    out = F.trim(F.regexp_replace(out, OTHER, " "))
    for spelling, usual in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(usual))
    return out


def canonical_sql(text: str) -> str:
    out = f"trim(regexp_replace(regexp_replace(lower({text}), '{SQL_COPYRIGHT_LINE}', chr(10), 'g'), '{OTHER}', ' ', 'g'))"
    for spelling, usual in SPELLINGS:
        out = f"replace({out}, '{spelling}', '{usual}')"
    return out


def known_digests() -> dict[str, str]:
    """Digest of the canonical form of each known text, and its licence."""
    out = {}
    for license_id, text in TEXTS:
        plain = re.sub(copyright_line("a-z", "0-9"), "\n", text.lower())
        plain = re.sub(r"[^a-z0-9]+", " ", plain).strip()
        for spelling, usual in SPELLINGS:
            plain = plain.replace(spelling, usual)
        out[hashlib.sha256(plain.encode()).hexdigest()] = license_id
    return out


def known(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{digest}', '{license_id}')" for digest, license_id in sorted(known_digests().items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS known(digest, license_id)")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         licenses: DataFrame | None = None) -> DataFrame:
    """Licences of each row: ``doc_id, digest, license_id, notices, n_notices``.

    ``digest`` is that of the whole text's canonical form and ``license_id`` the licence it is the text of, or null.
    ``notices`` lists the licences that single lines state, without repeats and in order, joined by commas; ``n_notices``
    counts the lines. A null text counts as empty, and an empty canonical form is no licence. Rows are judged each by
    itself, repeated ones and those without an id too. ``licenses`` (``digest, license_id``, one row a digest) replaces the
    known ones for whole texts; Spark broadcasts it if it is small enough and shuffles otherwise. Notices are always those
    of the fixed table. Empty input gives no rows.
    """
    licenses = known(docs.sparkSession) if licenses is None else licenses.select("digest", "license_id")
    text = F.coalesce(F.col("text"), F.lit(""))
    names = F.create_map(*(F.lit(x) for entry in sorted(known_digests().items()) for x in entry))
    # Every known notice holds one of these words, in one of its spellings.
    states = lambda line: line.rlike("(?i)licen[sc]e|permi")
    stated = F.transform(F.filter(F.split(text, "\n"), states),
                         lambda line: F.try_element_at(names, F.sha2(canonical(line), 256)))
    rows = only(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.sha2(canonical(text), 256).alias("digest"),
        F.filter(stated, lambda license_id: license_id.isNotNull()).alias("stated"))
    return rows.join(licenses, "digest", "left").select(
        "doc_id", "digest", "license_id",
        F.array_join(F.array_sort(F.array_distinct("stated")), ",").alias("notices"),
        F.size("stated").cast("long").alias("n_notices"))
