"""Hard documents: every operator must give them a defined result."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, key string, fp long, n_tokens string, kept string, word string"
)

# English words in an order, of which passages are made.
FLOW = (
    "the quick brown fox jumps over the lazy dog while seven wizards brew potions near quiet "
    "rivers and young pilots chart new courses through autumn skies before night falls again"
).split()


def passage(start: int, n: int) -> str:
    return " ".join(FLOW[(start + i * (1 + start % 3)) % len(FLOW)] for i in range(n))


PII = "Write to ann.lee@mail.example.org or +1 (555) 010-4477 from 10.0.0.7, card 4111 1111 1111 1111."
ODD = (
    "Ünïcode ﬁ 日本語 ½ Ⅷ \u200b\u00a0\u2028 <|endoftext|> 🙂\x00\x1c\x85 don't we'll\r\n\t 3.14 x" + "é" * 70
)
LONG = " ".join(f"{w}{i % 97}" for i in range(6000) for w in ("river", "Sky,"))

HARD = [
    (doc, text, lang, "s", None, 7, "k", -1, "t", "no", "w")
    for doc, text, lang in [
        (1, passage(0, 40), "en"),
        (2, passage(0, 40), "en"),  # a copy
        (2, passage(0, 40), "en"),  # a repeated row
        (3, passage(0, 39) + " dawn", "en"),
        (4, None, "en"),
        (5, "", "en"),
        (6, "  \t\n ", None),
        (None, passage(5, 30), "en"),
        (None, passage(5, 30), None),
        (8, PII, "en"),
        (9, ODD, "xx"),
        (10, LONG, None),
        (11, "a" * 30_000, "en"),
        (12, "1" * 5_000 + " " + "@" * 500, "en"),
        (13, "Two words", "en"),
        (14, "!!! ### 123", "en"),
        (15, passage(1, 60), "fr"),
        (15, passage(2, 60), "fr"),  # an id with another text
        (16, "one line\none line\n\none line\n", "en"),
        (17, " ".join(["again and again we say it"] * 9), "en"),
    ]
]
