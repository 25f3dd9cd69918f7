"""Small fixed lookup tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed values: (aggregation type, subtype) to genre of the batch source.
GENRES = [
    ("Journal", "Article", "article"),
    ("Conference Proceeding", "Conference Paper", "conferencePaperPublished"),
    ("Journal", "Review", "review"),
    ("Book", "Book Chapter", "chapter"),
    ("Journal", "Conference Paper", "articleConferencePaper"),
    ("Book Series", "Book Chapter", "chapter"),
    ("Book Series", "Editorial", "chapter"),
    ("Conference Proceeding", "Editorial", "conferencePaperPublished"),
    ("Journal", "Note", "article"),
    ("Book", "Book", "book"),
    ("Book", "Editorial", "chapter"),
    ("Journal", "Editorial", "editorialMaterial"),
    ("Journal", "Letter", "articleLetter"),
    ("Trade Journal", "Article", "articleOther"),
    ("Book Series", "Conference Paper", "conferencePaperPublished"),
    ("Journal", "Data Paper", "article"),
    ("Journal", "Erratum", "articleErratum"),
    ("Journal", "Short Survey", "article"),
    ("Conference Proceeding", "Book Chapter", "conferencePaperPublished"),
    ("Book Series", "Note", "chapter"),
]

# Document type to genre of the citation index; of repeated
# types the later meaning holds.
INDEX_GENRES = {
    "Article": "article",
    "Proceedings Paper": "conferencePaper",
    "Conference Paper": "conferencePaper",
    "Editorial Material": "editorialMaterial",
    "Meeting Abstract": "meetingAbstract",
    "Book Review": "bookReview",
    "Letter": "articleLetter",
    "Review": "article",
    "Correction": "article",
    "Erratum": "articleErratum",
    "News Item": "other",
    "Biographical-Item": "articleOther",
    "Discussion": "article",
    "Note": "editorialMaterial",
    "Book": "book",
    "Book Chapter": "chapter",
    "Correction, Addition": "article",
    "Data Paper": "article",
    "Database Review": "review",
    "Editorial": "editorialMaterial",
    "Retracted Publication": "article",
    "Retraction": "article",
    "Software Review": "review",
    "TV Review, Radio Review": "review",
    "TV Review, Radio Review, Video": "review",
    "Theater Review": "review",
}


def with_genre(df: DataFrame, aggregation: str, subtype: str, name: str = "genre") -> DataFrame:
    """Genre by the fixed twenty-row table, ``other`` where it has none."""
    fixed = df.sparkSession.createDataFrame(GENRES, "__a string, __s string, __g string")
    same = (F.col(aggregation) == F.col("__a")) & (F.col(subtype) == F.col("__s"))
    out = df.join(F.broadcast(fixed), same, "left")
    return out.withColumn(name, F.coalesce("__g", F.lit("other"))).drop("__a", "__s", "__g")


def index_genre(col):
    """Genre of a citation-index document type, ``other`` where unlisted."""
    out = None
    for kind, genre in INDEX_GENRES.items():
        out = F.when(col == kind, genre) if out is None else out.when(col == kind, genre)
    return out.otherwise("other")
