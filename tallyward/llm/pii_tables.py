"""The small labelled table that the personal-data model is trained from.

A sentence is words with labels.  Characters in the patterns are drawn from a fixed seed:
``9`` stands for any digit; in kinds of `DRAWN`, ``x`` for any hexadecimal digit, ``X`` for a
capital or a digit, and ``m`` for a letter of either case or a digit.  What stands before the
last word of those is a name of what follows and no personal data.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

#: What may stand for each kind of personal data.
PATTERNS = {
    "email": (
        "name99@mail9.example.com", "first.last@example.org", "a_b-c99@sub.host9.net",
        "word.99@mail9.example.com", "name99@mail9.example.com.", "<first.last@example.org>", "info@firma.de,",
    ),
    "ip": ("99.99.999.99", "199.99.9.99", "9.99.999.9,", "199.999.99.9.", "(99.9.99.199)", "99.999.99.99"),
    "card": (
        "9999999999999999", "9999 9999 9999 9999", "9999-9999-9999-9999", "9999999999999999.", "9999999999999999,",
        "9999 999999 99999", "(9999 9999 9999 9999)",
    ),
    "phone": (
        "+9 (999) 999-9999", "+99 99 99999999", "(999) 999-9999", "+99 999 9999-999", "+9-999-999-9999",
        "+9 (999) 999-9999,", "+999999999999", "0999 9999999", "0999-9999999", "(0999) 999999", "999-999-9999",
        "099 99999999", "09 99 99 99 99", "999.999.9999",
    ),
    "secret": (
        'token = "' + "x" * 40 + '"', 'key = "' + "x" * 32 + '"', "token: " + "x" * 40,
        'password = "' + "x" * 24 + '"', "token = " + "x" * 40, "key: AKIA" + "X" * 16, "AKIA" + "X" * 16 + ",",
        'key = "AKIA' + "X" * 16 + '"', "ghp_" + "m" * 36, "token: ghp_" + "m" * 36, 'secret: "' + "m" * 40 + '"',
        "Bearer " + "m" * 32, "api_key=" + "m" * 24, "sk_live_" + "m" * 24 + ".", "'" + "m" * 44 + "'",
    ),
    "account": (
        "DE99 9999 9999 9999 9999 99", "DE99999999999999999999", "ES99 9999 9999 9999 9999 9999", "IBAN: DE99 9999 9999 9999 9999 99,", "FR99 9999 9999 99XX XXXX XXXX X99",
        "ES9999999999999999999999", "GB99XXXX99999999999999,", "IBAN NL99XXXX9999999999", "CH99 9999 9999 9999 9999 9.",
    ),
    "identity": ("999-99-9999", "SSN 999-99-9999", "999-99-9999,", "(999-99-9999)", "ssn: 999-99-9999."),
}
#: How keys of well-known services begin.
KEY_BEGINNINGS = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "sk_live_", "sk_test_", "xoxb-", "xoxp-", "eyJ")
#: Kinds with further characters to draw, and what names one.
DRAWN = ("secret", "account")
NAMES = frozenset("token key password secret: token: key: Bearer = IBAN IBAN: SSN ssn:".split())
#: Sentences around them, and sentences with none.
FRAMES = (
    "Please write to {} or come by.", "The order of {} was sent.", "Bitte an {} schreiben.",
    "{} est dans la liste.", "Los datos de {} son para el archivo.", "Call {} today, or {} tonight.",
    "word | Word | {} | word.", "{}", "WORDS!! AND!! {} MORE!!", "Das ist {} und {} von ihm.",
)
CLEAN = (
    "The meeting is at 10 and lasts 2 hours.", "In 1998 there were 350 of them.", "Es kostet 12.50 Euro.",
    "Version 3 of the license, 2007.", "Chapter 12, page 345.", "From*** from*** here$$$ word%%% and&&& so###",
    "Word | word | word | word.", "THE!! AND!! OF!! 99!!", "A plain sentence, without anything in it.",
    "Le prix est de 1 200 euros.", "x = 5 and y = 7 so x + y = 12.", "On 2024-01-31 at 09:30 it was 25%.",
    "Copyright (c) 2019, 2020 the authors.", "El a, la de; que (y) no.", "1. First 2. Second 3. Third",
    "if (a == b) { return 0; }", "About 1,000,000 people @ home.", "See section 4.1.2 and table 7.",
)
#: Sentences per frame and kind, and copies of each clean one.
DRAWS, CLEAN_COPIES = 6, 4
_DIGITS = "0123456789"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SETS = {"x": "0123456789abcdef", "X": _CAPITALS + _DIGITS, "m": _CAPITALS + _CAPITALS.lower() + _DIGITS}


def _draw(pattern: str, kind: str, dice: random.Random) -> str:
    found = []
    for at, c in enumerate(pattern):
        drawn = _DIGITS if c == "9" else None
        if kind in DRAWN and c in _SETS and c * 2 in (pattern[at : at + 2], pattern[max(0, at - 1) : at + 1]):
            drawn = _SETS[c]  # at least two in a row, so that single letters of names stay
        found.append(dice.choice(drawn) if drawn else c)
    return "".join(found)


def _rows(kind: str, patterns: tuple[str, ...], dice: random.Random) -> Iterator[list[tuple[str, str]]]:
    for frame in FRAMES:
        for _ in range(DRAWS):
            row: list[tuple[str, str]] = []
            for part in frame.split():
                if part.strip(".,") != "{}":
                    row.append((part, "O"))
                    continue
                words = _draw(dice.choice(patterns), kind, dice).split()
                row += [(word, "O" if word in NAMES else kind) for word in words]
            yield row


def sentences(seed: int = 42, fold: int | None = None, folds: int = 1, held: bool = False) -> list[list[tuple[str, str]]]:
    """(word, label) lists; the label is the kind, or O.

    With a `fold`, the patterns whose place has that remainder by `folds` are left out, or
    with `held` are the only ones.
    """
    dice = random.Random(seed)
    found = []
    for kind, patterns in PATTERNS.items():
        if fold is not None:
            patterns = tuple(each for at, each in enumerate(patterns) if (at % folds == fold) == held)
        found += _rows(kind, patterns, dice) if patterns else []
    for text in CLEAN:
        found += [[(word, "O") for word in text.split()]] * CLEAN_COPIES
    return found
