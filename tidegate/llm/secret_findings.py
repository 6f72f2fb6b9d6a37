"""Labelled findings to train the secret scan from: texts with one value of known origin each.

A value is a secret because it was drawn at random as one and put where a person would leave one; it
is none because it was made as something else: an address, a number, a checksum, an identifier, a
stand-in. Labels say how a value was made, not how it looks; no pattern of the scanner takes part.
The texts are drawn by a seed, `DRAWS` for each kind.
"""

from __future__ import annotations

import random
import string
from collections.abc import Callable

DRAWS = 24
LETTERS, DIGITS, HEX = string.ascii_letters, string.digits, "0123456789abcdef"
PUNCTUATION = "!#%*+-_.@"
#: Where texts come from: places of real settings, and places of explanations and trials.
LIVE = ("config/prod.env", "deploy/values.yaml", "src/app/settings.py", "infra/main.tf", "ops/run.sh", "forum")
SHOWN = ("docs/guide.md", "tests/fixtures/login.json", "examples/quickstart.py", "spec/api.yaml")
WORDS = (
    "window", "server", "report", "garden", "update", "market", "simple", "letter", "engine", "travel", "summer", "result", "button", "signal",
    "planet", "module", "filter", "record", "session", "customer", "invoice", "control", "station", "manager", "builder", "network",
)
Draw = Callable[[random.Random], str]


def _drawn(rng: random.Random, alphabet: str, least: int, most: int | None = None) -> str:
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(least, most or least)))


def _password(rng: random.Random) -> str:
    return _drawn(rng, LETTERS + DIGITS + rng.choice(["", PUNCTUATION]), 8, 18)


def _phrase(rng: random.Random) -> str:
    """A password as people make them: words with a few changes."""
    return rng.choice(WORDS).capitalize() + rng.choice(PUNCTUATION) + rng.choice(WORDS) + _drawn(rng, DIGITS, 1, 4)


def _token(rng: random.Random) -> str:
    return _drawn(rng, rng.choice([LETTERS + DIGITS, HEX, LETTERS + DIGITS + "-_"]), 24, 48)


def _issued(rng: random.Random) -> str:
    return rng.choice(
        [
            lambda: "AKIA" + _drawn(rng, string.ascii_uppercase + DIGITS, 16),
            lambda: "gh" + rng.choice("pousr") + "_" + _drawn(rng, LETTERS + DIGITS, 36),
            lambda: "xox" + rng.choice("abp") + "-" + _drawn(rng, DIGITS, 11) + "-" + _drawn(rng, LETTERS + DIGITS, 24),
            lambda: "AIza" + _drawn(rng, LETTERS + DIGITS + "_-", 35),
            lambda: "sk_live_" + _drawn(rng, LETTERS + DIGITS, 24),
            lambda: "npm_" + _drawn(rng, LETTERS + DIGITS, 36),
            lambda: "sk-" + _drawn(rng, LETTERS + DIGITS, 40),
            lambda: "eyJ" + _drawn(rng, LETTERS + DIGITS, 20) + ".eyJ" + _drawn(rng, LETTERS + DIGITS, 40) + "." + _drawn(rng, LETTERS + DIGITS + "-_", 30),
        ]
    )()


def _name(rng: random.Random) -> str:
    style = rng.randrange(3)
    parts = [rng.choice(WORDS) for _ in range(rng.randint(2, 3))]
    if style == 0:
        return "".join(p.capitalize() for p in parts) + _drawn(rng, DIGITS, 1, 2)
    return ("_" if style == 1 else "-").join(parts) + rng.choice(["_", "-", ""]) + _drawn(rng, DIGITS, 1, 3)


def _uuid(rng: random.Random) -> str:
    return "-".join(_drawn(rng, HEX, n) for n in (8, 4, 4, 4, 12))


def _stamp(rng: random.Random) -> str:
    return f"20{rng.randint(10, 29)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(0, 23):02}:{rng.randint(0, 59):02}:00Z"


def _stand_in(rng: random.Random) -> str:
    return rng.choice(
        ["changeme1", "your-password-1", "example123", "xxxxxxxx1", "<password1>", "${DB_PASSWORD1}", "test1234", "placeholder0", "YOUR_TOKEN_HERE_1", "dummy-secret-0", "password123"]
    )


#: (secret or not, text with {} for the value, how the value is drawn, where it may stand)
KINDS: list[tuple[int, str, Draw, tuple[str, ...]]] = [
    (1, "export DB_PASSWORD={}\n", _password, LIVE),
    (1, "the login is admin and the password: {} as before", _password, LIVE),
    (1, "set passwd {} on the box", _password, LIVE),
    (1, 'pwd = "{}"', _phrase, LIVE),
    (1, "password={} works for me", _phrase, LIVE),
    (1, '{{"api_key":"{}","retries":3}}', _token, LIVE),
    (1, "Authorization token {} was sent", _token, LIVE),
    (1, "secret: {}", _token, LIVE),
    (1, "http://x.example.net/?user=bob&access_key={}&page=2", _token, LIVE),
    (1, "postgres://bob:{}@db7/main", _token, LIVE),
    (1, "we rotated {} yesterday", _issued, LIVE),
    (1, "key {} there", _issued, LIVE + SHOWN),
    (1, "token={}", _issued, LIVE),
    (0, "write to {} please", lambda r: f"{r.choice(WORDS)}{_drawn(r, DIGITS, 1, 3)}.{r.choice(WORDS)}@mail{_drawn(r, DIGITS, 1, 2)}.example.com", LIVE + SHOWN),
    (0, "see {} for more", lambda r: f"https://www.{r.choice(WORDS)}.org/{r.choice(WORDS)}/{_drawn(r, DIGITS, 4)}/{_name(r)}.html", LIVE + SHOWN),
    (0, "from {} on", lambda r: ".".join(str(r.randint(1, 255)) for _ in range(4)) + f":{r.randint(1000, 9999)}", LIVE + SHOWN),
    (0, "call 555-{} today", lambda r: _drawn(r, DIGITS, 4) + "-" + _drawn(r, DIGITS, 6, 8), LIVE + SHOWN),
    (0, "card {} on file", lambda r: _drawn(r, DIGITS, 16), LIVE + SHOWN),
    (0, "built at {} by hand", _stamp, LIVE + SHOWN),
    (0, "sha256 of the file: {}", lambda r: _drawn(r, HEX, 64), LIVE + SHOWN),
    (0, "commit {} fixed it", lambda r: _drawn(r, HEX, 40), LIVE + SHOWN),
    (0, "order {} was shipped", _uuid, LIVE + SHOWN),
    (0, "call {} in the loop", _name, LIVE + SHOWN),
    (0, "open images/{}.jpg first", lambda r: f"IMG_20{_drawn(r, DIGITS, 6)}_{_drawn(r, DIGITS, 6)}", LIVE + SHOWN),
    (0, "needs {} or newer", lambda r: f"{r.choice(WORDS)}-{r.randint(1, 9)}.{r.randint(0, 30)}.{r.randint(0, 9)}-beta{r.randint(1, 9)}", LIVE + SHOWN),
    (0, "password={} is what you type", _stand_in, SHOWN),
    (0, "for example token: {} in the header", _stand_in, SHOWN),
    (0, "odd text {} of symbols", lambda r: "".join(r.choice(WORDS) + r.choice(["***", "$$$", "%%%", "&&&"]) for _ in range(3)) + "1", LIVE + SHOWN),
]


def labelled_texts(draws: int = DRAWS, seed: int = 29) -> list[tuple[int, str, str, str, int, int]]:
    """(number, text, source, value, secret or not, which draw) of every kind."""
    rng = random.Random(seed)
    out = []
    for draw in range(draws):
        for is_secret, text, value_of, sources in KINDS:
            value = value_of(rng)
            around = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))
            said = f"{around} {text.format(value)} {rng.choice(WORDS)}".strip()
            out.append((len(out), said, rng.choice(sources), value, is_secret, draw))
    return out
