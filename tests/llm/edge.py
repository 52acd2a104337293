"""Rows every operator has to bear, and brute-force forms of what operators do."""

import re

PROSE = (
    "the river runs past old mills and quiet farms until it meets the sea near a small town "
    "where boats leave at dawn with nets and lamps and come home late with silver fish for "
    "the market on the square while children watch from the wall and count each sail"
).split()
LONG = " ".join(f"{w}{i % 97}" for i, w in enumerate(PROSE * 700))

# Clashing extra columns, NULLs in any column, empty, blank and very long texts, repeats, ties.
EDGE_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, h long, key string, "
    "id long, component long, rank long, kept boolean, n_words long, score double, rows int"
)
_EXTRA = (1, "k", 2, 3, 4, True, 5, 0.5, 6)
EDGE = [
    (1, " ".join(PROSE), "en", "a", 10, *_EXTRA),
    (1, " ".join(PROSE), "en", "a", 10, *_EXTRA),
    (2, " ".join(PROSE), "en", "a", None, *_EXTRA),
    (3, " ".join(PROSE[:30] + ["changed"] + PROSE[30:]), "en", None, 1, *_EXTRA),
    (4, None, "en", "b", None, *_EXTRA),
    (5, "", "en", "b", 0, *_EXTRA),
    (6, " \n\t\x0b ", None, "b", 0, *_EXTRA),
    (7, LONG, "en", "a", 1, *_EXTRA),
    (8, LONG + "\nend", "en", "a", 1, *_EXTRA),
    (None, " ".join(PROSE), "en", "a", 1, *_EXTRA),
    (None, None, None, None, None, *[None] * 9),
    (9, "Ünï çödé ñandú 中文 <|endoftext|> 1,5 km", None, "c", 1, *_EXTRA),
    (10, "the", "en", "c", 1, *_EXTRA),
    (11, "x x x x x x x x\nx\nx", "de", "c", 1, *_EXTRA),
]


def edge(spark):
    return spark.createDataFrame(EDGE, EDGE_SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def read(spark, name, sf="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")
