"""Secret scans: patterns, and a conditional random field that tags words as begin, inside or outside of a secret."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame

from corpusq.llm import crf
from corpusq.llm.texts import map_texts

#: The base patterns, in the order in which ties are listed.
KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20
ORDER = {"assign": 0, "access": 1, "hex": 2, "crf": 3}

SCHEMA = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_crf bigint"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the patterns, by start, then kind as listed. Runs of hex digits are maximal, so the length can be part of the pattern."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


# The model: what it looks at.

_HINTS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "key", "bearer", "authorization", "auth", "credential", "private", "passphrase", "pass")
_PREFIXES = ("ghp_", "gho_", "github_pat_", "sk-", "sk_live_", "pk_live_", "xoxb-", "xoxp-", "eyJ", "AIza", "glpat-", "npm_", "hf_", "SG.", "ya29.", "-----BEGIN", "-----END")
#: Words end at quotes, brackets, tags, = and :, which stay with the word before them as they tell a name from a value.
#: URLs stay whole, but for one with a password: its scheme and user are a name, the password is a word.
WORD = re.compile(
    r"""[A-Za-z][A-Za-z0-9+.-]*://[^\s"'`<>/@:]*:(?=[^\s"'`<>/@]+@)|(?<=:)[^\s"'`<>/@:]+(?=@)|[A-Za-z][A-Za-z0-9+.-]*://[^\s"'`<>]+"""
    r"""|[^\s"'`<>(){}\[\],;:=]+(?:["'`>]?[:=]+>?)?|[:=]+>?"""
)
_RUNS = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^A-Za-z0-9]+")
_QUOTES = "\"'`,;()[]{}<>"


def _shape(word: str) -> str:
    kinds = ["X" if r[0].isupper() and r.isascii() else "x" if r.isalpha() else "9" if r.isdigit() else r[0] for r in _RUNS.findall(word)]
    return "".join(k for j, k in enumerate(kinds) if j == 0 or kinds[j - 1] != k)


def _bits(word: str) -> float:
    """Entropy of the characters."""
    n = len(word)
    return -sum(c / n * math.log2(c / n) for c in Counter(word).values()) if n else 0.0


def _hint(word: str) -> str | None:
    if word.endswith(":") and "://" in word:
        return "user"
    low = word.lower().strip(_QUOTES + ":=")
    if not low.endswith(_HINTS):
        return None
    return next((h for h in _HINTS if low.endswith(h)), None)


def own_features(word: str) -> list[str]:
    core = word.strip(_QUOTES)
    upper, lower = core != core.lower(), core != core.upper()
    digit = not core.isalpha() and any(map(str.isdigit, core))
    mixed = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:])) if digit else 0
    size = min(len(core), 64).bit_length() if len(core) < 20 else 5 + len(core) // 20 if len(core) < 100 else 10
    found = ["bias", f"size={size}", f"case={upper:d}{lower:d}{digit:d}", f"mixed={min(mixed, 6)}"]
    if len(core) >= 8 and (digit or not core.isalpha()):
        found.append(f"bits={int(2 * _bits(core))}/{size}")
        found.append(f"dense={upper + lower + digit}/{size}/{min(mixed, 3)}")
    if word.isalpha():
        found.append("word")
    else:
        found.append("shape=" + _shape(word))
        found.append("marks=" + "".join(sorted({c for c in core if not c.isalnum()})))
    if h := _hint(word):
        found.append("hint=" + h)
        found.append("hint+" + word[-1:])
    for p in _PREFIXES:
        if core.startswith(p):
            found += ["prefix=" + p, "prefix", f"prefix/{size}"]
    return found


def word_class(word: str) -> int:
    """1-2 a hint word, closed by a mark or not; 3 an assignment mark; 4 a key header; 5-6 a long mixed word; 7 short words of letters, 8 others."""
    if _hint(word):
        return 1 if word[-1] in ":=>" else 2
    if word in ("=", ":", ":=", "=>", "==", "->"):
        return 3
    if word.startswith("-----"):
        return 4
    if len(word) >= 16 and any(map(str.isdigit, word)) and any(map(str.isalpha, word)):
        return 5 if word.isascii() else 6
    return 7 if word.isalpha() else 8


def text_class(text: str) -> int:
    """File features: 1 for code or settings by its marks, 2 for a key block, 0 for prose."""
    if "-----BEGIN" in text:
        return 2
    marks = text.count("=") + text.count("{") + text.count(";") + text.count("://")
    return int(marks > 0 and 200 * marks > len(text))


def chains(text: str) -> list[tuple[int, int]]:
    """Lines; those of a key block, from a BEGIN to the next END, are one chain."""
    found = crf.lines(text)
    if "-----BEGIN" not in text:
        return found
    joined, block = [], None
    for a, b in found:
        begins = text.find("-----BEGIN", a, b) >= 0
        if block is None or begins:
            # A block without an end is lines again.
            joined += block or []
            block = [(a, b)] if begins else None
            if not begins:
                joined.append((a, b))
        else:
            block.append((a, b))
        if block and text.find("-----END", a, b) >= 0:
            joined.append((block[0][0], b))
            block = None
    return joined + (block or [])


FEATURES = crf.Features(("O", "B-crf", "I-crf"), own_features, word_class, 9, text_class, 3, word=WORD, chains=chains)


def labelled_lines(seed: int = 5, size: int = 1500) -> list[tuple[str, str]]:
    """The small labelled table: lines whose secrets stand between « and », made from patterns and a seed."""
    r = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    prose = lambda: " ".join(_prose_word(r) for _ in range(r.randint(2, 14)))
    value = lambda: r.choice([
        lambda: draw(alnum, r.randint(14, 48)), lambda: draw(alnum + "+/", r.randint(20, 60)) + r.choice(["", "=", "=="]),
        lambda: draw(alnum, 5) + r.choice("!@#_-") + draw(alnum, r.randint(6, 12)),
    ])()
    known = lambda: r.choice([
        lambda: "ghp_" + draw(alnum, 36), lambda: "sk-" + draw(alnum, r.randint(32, 48)), lambda: "sk_live_" + draw(alnum, 24),
        lambda: f"xoxb-{draw('0123456789', 11)}-{draw(alnum, 24)}", lambda: "AIza" + draw(alnum + "_-", 35), lambda: "glpat-" + draw(alnum, 20),
        lambda: f"eyJ{draw(alnum, 33)}.eyJ{draw(alnum, 60)}.{draw(alnum + '_-', 43)}", lambda: "hf_" + draw(alnum, 34), lambda: "npm_" + draw(alnum, 36),
        lambda: f"SG.{draw(alnum, 22)}.{draw(alnum, 43)}",
    ])()
    plain = lambda: r.choice([
        lambda: str(r.randint(0, 99999)), lambda: f"{r.randint(1, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}",
        lambda: f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", lambda: f"{_prose_word(r)}.{r.randint(0, 99)}@mail{r.randint(1, 9)}.example.com",
        lambda: f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda: f"https://www.{_prose_word(r)}.org/{_prose_word(r)}/{r.randint(1, 9999)}?id={r.randint(1, 99)}",
        lambda: draw("0123456789", 16), lambda: f"v{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}", lambda: f"{_prose_word(r)}{r.choice(['***', '$$$', '%%%', '###', '&&&', '!!', '.', ',', ' |'])}",
        lambda: _prose_word(r).upper() + "!!", lambda: f"{_prose_word(r)}_{_prose_word(r)}()", lambda: f"{_prose_word(r)}-{_prose_word(r)}-{_prose_word(r)}",
        lambda: "".join(_prose_word(r) for _ in range(5)), lambda: f"ISBN 978-{draw('0123456789', 10)}", lambda: f"/usr/{_prose_word(r)}/{_prose_word(r)}.py",
        lambda: f"{draw('0123456789abcdef', 8)}-{draw('0123456789abcdef', 4)}-4{draw('0123456789abcdef', 3)}-a{draw('0123456789abcdef', 3)}-{draw('0123456789abcdef', 12)}",
        lambda: _prose_word(r).capitalize() + _prose_word(r).capitalize() + str(r.randint(1, 99)),
    ])()
    names = ["pwd", "passphrase", "PASSPHRASE", "private_key", "auth", "db_pass", "client_secret", "accessKey", "DB_PASSWORD", "authToken", "credential", "t", "key"]
    secret = lambda: r.choice([known, value])()
    word = lambda: _prose_word(r).strip(",.")
    field = lambda: r.choice([word, lambda: f"{word()}_{word()}", lambda: word().upper()])()
    simple = lambda: r.choice([word, prose, plain, plain])()
    pair = lambda: r.choice([
        lambda: f'"{field()}":"{simple()}"', lambda: f'"{field()}": {r.randint(0, 9999)}', lambda: f"{field()}={simple()}", lambda: f"{field()}='{simple()}'",
        lambda: f"<{field()}>{simple()}</{field()}>", lambda: f'{field()}="https://{word()}.org/{word()}/{r.randint(1, 999)}"', lambda: f"{field()}({word()}, {r.randint(0, 99)})",
        lambda: f'"url":"https://{word()}.example.com:{r.randint(80, 9999)}/{word()}"', lambda: f"mailto:{word()}@{word()}.example.com", lambda: f"{field()}: {word()}", lambda: f"{r.randint(0, 23)}:{r.randint(10, 59)}",
    ])()
    hidden = lambda: r.choice([
        lambda: f'"{r.choice(names)}":"«{secret()}»"', lambda: f'"{r.choice(names)}": "«{secret()}»"', lambda: f"{r.choice(names)}=«{secret()}»", lambda: f"{r.choice(names)}='«{secret()}»'",
        lambda: f"<{r.choice(names)}>«{secret()}»</{r.choice(names)}>", lambda: f'"{field()}":"«{known()}»"', lambda: f"{field()}=«{known()}»", lambda: f"({known()})".replace("(", "(«").replace(")", "»)"),
        lambda: f"{r.choice(['postgres', 'mysql', 'https', 'redis', 'amqp'])}://{r.choice([word(), ''])}:«{r.choice([value, lambda: word() + draw(alnum, 4)])()}»@{word()}.{r.choice(['internal', 'example.com'])}:{r.randint(80, 9999)}/{word()}",
        lambda: f"{r.choice(['PASSPHRASE', 'passphrase', 'pwd', 'DB_PASS'])}=«{word()}{draw('0123456789', r.randint(1, 4))}{word()}»",
    ])()
    rows = []
    for k in range(size):
        kind = r.random()
        if kind < 0.25:
            line = f"{prose()} {r.choice(['', 'key ', 'use ', 'is ', 'token ', 'credential: '])}«{known()}» {prose()}"
        elif kind < 0.4:
            hint = r.choice(["pwd", "passphrase", "private_key", "auth", "credential", "client_secret", "access key", "pass"])
            line = f"{r.choice(['', prose() + ' '])}{hint}{r.choice([':', ' =', ' :', '='])} «{value()}» {r.choice(['', prose()])}"
        elif kind < 0.47:
            line = f"Authorization: {r.choice(['Bearer', 'Basic', 'bearer', 'token'])} «{value()}»"
        elif kind < 0.5:
            name, cut = r.choice(["", "RSA ", "EC ", "OPENSSH "]) + "PRIVATE KEY", r.choice([" ", "\n", "\n"])
            body = cut.join([*(draw(alnum + "+/", 64) for _ in range(r.randint(0, 6))), draw(alnum + "+/", r.randint(8, 63)) + r.choice(["", "=", "=="])])
            line = f"«-----BEGIN {name}-----{cut}{body}{cut}-----END {name}-----»"
        elif kind < 0.53:
            line = f"{prose()} {r.choice(['password', 'token', 'secret', 'key', 'auth', 'pass'])} {prose()}"
        elif kind < 0.56:
            line = f"{r.choice(['the key', 'this token', 'a secret', 'auth', 'pass', 'key'])}{r.choice([':', ' is', ''])} {prose()} {plain()}"
        elif kind < 0.8:
            pairs = [pair() for _ in range(r.randint(0, 4))] + ([hidden()] if kind < 0.7 else [pair()])
            r.shuffle(pairs)
            line = r.choice([",", ", ", " ", "; ", "&", " "]).join(pairs)
            line = r.choice(["{%s}", "%s", "%s", "<%s>"]) % line.replace("%", "%")
        else:
            line = " ".join(r.choice([prose, plain, plain])() for _ in range(r.randint(1, 4)))
        rows.append((line, r.choice(["", "", "x = 1; y = {2};\n" if k % 2 else ""])))
    return rows


def _prose_word(r: random.Random) -> str:
    parts = "th er on an re he in ed nd ha es ti en st ou ly ing tion de la que ier eau ung sch heit ción ado ß é ü ñ è".split()
    word = "".join(r.choice(parts) for _ in range(r.randint(1, 4)))
    return r.choice([word, word, word, word.capitalize(), word + ",", word + "."])


@lru_cache
def default_model() -> crf.Model:
    rows = []
    for line, rest in labelled_lines():
        text, spans = crf.marked(line, {"«»": "crf"})
        rows.append((*crf.tagged(text, spans, FEATURES), text_class(rest + text)))
    return crf.train(rows, FEATURES)


def scan_secrets(docs: DataFrame, keep: list[str], model: crf.Model | None = None, text: str = "text") -> DataFrame:
    """Secrets of every whole text, one row per input row; spans in code points, end exclusive.

    Pattern matches always stay; the model adds ``crf`` spans that touch none of
    them. A null or empty text has no spans. The model is trained on the driver
    from the small labelled table and sent to the tasks (under 1 MB).
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or default_model())

    def make():
        decoder = crf.Decoder(sent.value)

        def work(texts):
            found = [scan(t, s) for t, s in zip(texts, decoder.spans(texts))]
            return {name.split()[0]: [row[k] for row in found] for k, name in enumerate(SCHEMA.split(", "))}

        return work

    return map_texts(docs, keep, make, SCHEMA, text)


def scan(text: str, learned: list[tuple[str, int, int]]) -> tuple:
    base = base_spans(text)
    added = crf.beside(learned, base)
    every = sorted(base + added, key=lambda s: (s[1], ORDER[s[0]]))
    count = Counter(kind for kind, _, _ in base)
    digest = hashlib.sha256(crf.joined(base).encode()).hexdigest()
    return count["assign"], count["access"], count["hex"], digest, crf.joined(every), len(added)
