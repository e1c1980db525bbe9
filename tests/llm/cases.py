"""Inputs that several tests share."""

#: Nulls, empty and odd texts, ties, a repeated row and a repeated id.
ODD_TEXTS = [
    (None, None),
    (None, "a text without an id"),
    (1, None),
    (2, ""),
    (3, " \t\n\n "),
    (4, "Grüße aus Köln, 12 Äpfel! <|startoftext|> it's it's"),
    (5, "same text here\nsame text here"),
    (5, "same text here\nsame text here"),
    (6, "same text here\nsame text here"),
    (6, "another text with the same id"),
    (7, "word " * 5000),
    (8, "x" * 20000),
    (9, "\x00\x1c ​  \U0001f600"),
]
