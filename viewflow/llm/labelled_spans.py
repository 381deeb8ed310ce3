"""Labelled candidates of personal data: generated texts with a span that is a kind's or is none.

Whether a span counts does not follow from the base patterns: forms that they miss count too (spelled-out addresses,
national numbers, IPv6, dotted cards), by form and by the words before it. In a format `d` is any digit, `x` a
hexadecimal one, `w` a word, `o` a number up to 255; `L` before it: the digits pass Luhn's check, `N`: they don't.
"""

from __future__ import annotations

import random
import re

#: Texts of each format and context.
EACH = 4
_PLAIN = ["%s", "The office is %s in the week.", "and then %s was written there", "Ask for me, %s, please", "(%s)"]
_CUE = {
    "email": ["mail me: %s", "contact %s now", "write to %s today"],
    "ip": ["ip %s", "the host %s is down", "server %s answers"],
    "card": ["card %s", "pay by visa %s today", "credit card no. %s"],
    "phone": ["phone: %s", "call %s today", "tel. %s", "my mobile is %s", "fax %s"],
}
_OTHER = ["order %s", "invoice no. %s", "version %s", "serial %s of it", "item %s is sold", "isbn %s", "total %s", "date %s"]
#: Kind, formats, and whether one counts after a word that names the kind, in plain text, after a word that names
#: something else; None where people would not agree.
_FORMS = [
    ("phone", ["(ddd) ddd-dddd", "(ddd) ddd dddd", "(0dd) dddd dddd", "(0ddd) ddd ddd", "(ddd)-ddd-dddd"], True, True, None),
    ("phone", ["ddd-ddd-dddd", "ddd.ddd.dddd", "00dd dd dddd dddd", "00dd ddd ddd dddd", "001 ddd ddd dddd", "00dd-ddd-ddd-ddd", "+dd dd dddd dddd"], True, True, False),
    ("phone", ["0dd dddd dddd", "0ddd ddd ddd", "0d dd dd dd dd", "ddd ddd dddd", "dd dddd dddd", "0dd-dddd-dddd", "0dd-ddd-ddd"], True, False, False),
    ("phone", ["20dd-1d-2d", "19dd-0d-1d", "1d.0d.20dd", "2d-1d-19dd", "2d.0d.19dd", "20dd.1d.0d", "d.ddd.ddd", "d ddd ddd", "20dd 20dd 20dd"], False, False, False),
    ("phone", ["dd dd dd", "dd dd dd dd", "ddd ddd ddd", "dddd dddd dddd", "dd dd dd dd dd", "dd.dd.dd", "d dd dd", "Ndddd dddd dddd dddd", "1dd.1dd.1dd.1dd"], None, False, False),
    ("email", ["w (at) w (dot) w", "w.w (at) w (dot) w", "w [at] w [dot] com", "w(at)w.com", "w [at] w.org", "w.w (at) w.net", "w [at] w.w.de", "w @ w.com", "w.w @ w.net", "wd @ w.w.org", "w@w.com", "wd@w.w.fr"], True, True, None),
    ("email", ["d @ d.dd", "w @ d.dd", "w @ dd.dd", "w (at) d.dd", "w [at] w.dd", "w @ w . w", "w (at) w . w", "w @ w.w"], False, False, False),
    ("ip", ["xxxx:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx", "2dd1:db8:x:x:x:x:x:xx", "fe80:x:x:x:xxx:xxxx:xxxx:xxxx"], True, True, None),
    ("ip", ["2dd1:db8::d", "fe80::d", "fe80::xxx:xxxx:dxxx:xxxx", "2dd1:dbd::xx:xx", "2ddx:xx:xx::d", "fddx:x::xxx:d"], True, True, None),
    ("ip", ["o . o . o . o", "o. o. o. o", "o.o.o.o"], True, True, False),
    ("ip", ["ab::cd", "f::a", "face::add", "dd::dd", "d::d", "9dd.d.d.d", "3dd . d . d . d", "d.d.7dd.d", "std::f", "a::be"], False, False, False),
    ("card", ["Ldddd.dddd.dddd.dddd", "Ldddd  dddd  dddd  dddd", "Ldddd - dddd - dddd - dddd", "Ldddd dddd dddd dddd", "Ldddddddddddddddd", "Ldddddddddddddddddd", "Ldddd. dddd. dddd. dddd"], True, True, None),
    ("card", ["L3ddd dddddd ddddd", "L3ddd.dddddd.ddddd", "Lddddddddddddddd", "Lddddddddddddd", "Ldddd dddddd dddd"], True, False, False),
    ("card", ["Ndddd.dddd.dddd.dddd", "Ndddd  dddd  dddd  dddd", "Ndddd dddd dddd dddd", "Ndddddddddddddddd", "N3ddd dddddd ddddd", "Nddddddddddddd", "Ndddddddddddddddddd"], False, False, False),
]
_WORDS = "anna bob carl dora erwin fritz greta hugo ida jan karin lena home office shop people garden mountain river".split()


def _luhn(text: str, good: bool) -> str:
    """The text with a last digit by which its digits pass Luhn's check, or not."""
    digits = [int(c) for c in text if c.isdigit()]
    total = sum(d * 2 - 9 * (d > 4) if i % 2 == 0 else d for i, d in enumerate(digits[-2::-1]))
    return text[:-1] + str((-total + (not good) * 3) % 10)


def _filled(form: str, rng: random.Random) -> str:
    made = {"d": lambda: rng.choice("0123456789"), "x": lambda: rng.choice("0123456789abcdef"), "w": lambda: rng.choice(_WORDS), "o": lambda: str(rng.randrange(256))}
    # A place holder is none where it belongs to a fixed word.
    text = re.sub(r"\b(?:dot|com|org|net|de|db8|add|face|ab|cd|std|be)\b|[dxwo]", lambda m: made[m[0]]() if len(m[0]) == 1 else m[0], form.lstrip("LN"))
    return _luhn(text, form[0] == "L") if form[0] in "LN" else text


def labelled() -> list[tuple[str, str, str, bool]]:
    """Text, kind, span, and whether it counts; the same in each run."""
    rng, out = random.Random(7), []
    for kind, forms, cue, plain, other in _FORMS:
        for form in forms:
            for contexts, counts in ((_CUE[kind], cue), (_PLAIN, plain), (_OTHER, other)):
                for context in contexts if counts is not None else []:
                    for _ in range(EACH):
                        span = _filled(form, rng)
                        out.append((context % span, kind, span, counts))
    return out
