"""Rows that every operator on documents has to bear: doc_id, text, lang, source."""

ODD = [
    (1, "Alpha beta gamma delta epsilon zeta.", "en", "a"),
    (1, "Alpha beta gamma delta epsilon zeta.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (4, " \n\t ", None, "b"),
    (5, "12345 !!", "en", None),
    (None, "no id here", None, "a"),
    (None, "no id here", None, "a"),
    (6, "word " * 60000, "en", "c"),
    (7, "x" * 30000, None, "c"),
    (8, "日本語 text   mixed\r\n'll", "de", "c"),
]
