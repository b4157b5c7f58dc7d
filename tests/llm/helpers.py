"""Small corpora with every kind of dirt, and plain versions of what the operators compute."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LINE = "  This is the Line that many documents hold in common, É included. \t"
LONG = " ".join(f"word{i}" for i in range(4000)) + ". The end of a very long text"

TEXTS = [
    None, "", " \t\r\n", "one", "one two three four", "ONE two  three\tfour", "one two three four five",
    "É é ÀB c d e f", f"{LINE}\nfirst", f"second\n{LINE.strip().upper().replace('É', 'É')}",
    f"{LINE}\n{LINE}\nthird", f"{LINE}fourth", f"a\n{LINE}\n\n", f"{LINE}\nsixth", f"b\n\n{LINE}", LONG,
    LONG + "!", "Released under the MIT License.\nMIT  license", "GNU General-Public/License v3",
    "x" * 50, "12 34 5 67 8 9", "日本語 の テキスト", "a\x00b c d\x1ce f", "the same words " * 60,
    "Licensed under the Apache License, Version 2.0.", "'s it's I'LL  don't\n\n 'tis '' 3rd ²",
]


def rows(texts=TEXTS):
    """Documents with those texts, two copies of one row, a shared identifier, a missing one."""
    made = [
        (i, t, ("en", "fr", None)[i % 3], ("a", "b", None, "ä", "Z")[i % 5], len(t) if t else 0)
        for i, t in enumerate(texts)
    ]
    return [*made, made[4], (4, "another text with the identifier four", "en", "a", 5),
            (None, "a text without identifier", "fr", "b", 1), (None, None, None, None, None)]


def words(text):
    return WORD.findall(text or "")


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
