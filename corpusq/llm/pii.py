"""Personal data: patterns, and a conditional random field over word shapes, trained from a small labelled table."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusq.llm import crf
from corpusq.llm.texts import map_rows, map_texts

#: The base patterns. Possessive repeats and the look-behind keep long runs of digits linear and change no match.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ORDER = {"email": 0, "ip": 1, "card": 2, "phone": 3, "crf_phone": 4, "crf_account": 5}

SCHEMA = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_crf bigint"


def emails(text: str) -> list[tuple[str, int, int]]:
    """From each @: back over the local part, then the domain ahead. As all starts in a run of local characters meet the same @, the first one decides."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append(("email", start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", max(free, at + 1))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the patterns that hold, by kind as listed, then start."""
    found = emails(text)
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(_byte(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# The model: what it looks at.

#: Words end at quotes, tags, brackets but round ones, =, : and ; and at commas before no digit.
WORD = re.compile(r"""(?:[^\s"'`<>\[\]{}=:;,|&]|,(?=[0-9]))+""")
_RUNS = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^A-Za-z0-9]")
_PHONE_HINTS = ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone", "cell", "whatsapp", "anrufen")
_ACCOUNT_HINTS = ("ssn", "iban", "passport", "social", "security", "account", "konto", "cuenta", "compte", "taxpayer")
_NUMBER_WORDS = ("number", "no", "nr", "num", "nummer", "número", "numéro", "id")
_STRIP = "\"'`,;[]{}<>.:!?#*$%&|"


def _shape(core: str) -> str:
    """Runs with their lengths up to 9: letters X and x, digits 9, marks as they are."""
    out = []
    for r in _RUNS.findall(core):
        kind = "9" if "0" <= r[0] <= "9" else "X" if "A" <= r[0] <= "Z" else "x" if "a" <= r[0] <= "z" else r
        out.append(f"{kind}{min(len(r), 9)}" if kind in "9Xx" else kind)
    return "".join(out)


def _hint(word: str) -> int:
    low = word.lower().strip(_STRIP)
    return 1 if low in _PHONE_HINTS else 2 if low in _ACCOUNT_HINTS else 0


def own_features(word: str) -> list[str]:
    core = word.strip(_STRIP)
    if core.isalpha() or not any("0" <= c <= "9" for c in core):
        return ["bias", "no digit", f"hint={_hint(word)}", f"number={word_class(word) == 10}", f"open={word[:1] == '('}"]
    digits = sum("0" <= c <= "9" for c in core)
    shape = _shape(core)
    return [
        "bias", "digits", f"n={min(digits, 24)}", "shape=" + shape, "loose=" + re.sub(r"[0-9]", "", shape.replace("9", "d")),
        f"marks={''.join(sorted({c for c in core if not c.isalnum()}))}", f"letters={any(c.isalpha() for c in core)}", f"whole={core.isdigit()}/{digits}",
    ]


_CLASSES = {"(999)": 3, "999": 4, "9999": 5, "999-9999": 6, "XX99": 7}


def word_class(word: str) -> int:
    """1 and 2: hints of phones and accounts, 3-7 parts of numbers by shape, 8 other words with digits, 9 words without, 10 those that announce a number."""
    if h := _hint(word):
        return h
    if word.lower().strip(_STRIP) in _NUMBER_WORDS:
        return 10
    core = word.strip(_STRIP)
    if core.isalpha() or not any("0" <= c <= "9" for c in core):
        return 9
    plain = re.sub(r"[A-Z]", "X", re.sub(r"[0-9]", "9", core))
    return _CLASSES.get(plain, 8)


def text_class(text: str) -> int:
    """The words beside a number tell its kind, whatever the text: all texts are of class 0."""
    return 0


FEATURES = crf.Features(
    ("O", "B-crf_phone", "I-crf_phone", "B-crf_account", "I-crf_account"), own_features, word_class, 11, text_class, 1, 2**12, word=WORD
)
_MARKS = {"«»": "crf_phone", "‹›": "crf_account"}


def labelled_lines(seed: int = 11, size: int = 1600) -> list[str]:
    """The small labelled table: lines with phones in « » and accounts in ‹ ›, made from patterns and a seed."""
    r = random.Random(seed)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    parts = "th er on an re he in ed nd ha es ti en st la que ier eau ung sch heit ción ado ß é ü".split()
    word = lambda: "".join(r.choice(parts) for _ in range(r.randint(1, 4))) + r.choice(["", "", "", ",", "."])
    prose = lambda a=1, b=9: " ".join(word() for _ in range(r.randint(a, b)))
    phone = lambda: r.choice([
        lambda: f"({n(3)}) {n(3)}-{n(4)}", lambda: f"{n(3)}-{n(3)}-{n(4)}", lambda: f"{n(3)}.{n(3)}.{n(4)}", lambda: f"0{n(2)} {n(4)} {n(4)}", lambda: f"({n(3)}){n(3)}-{n(4)}",
        lambda: f"1-{n(3)}-{n(3)}-{n(4)}",
    ])()
    hinted = lambda: r.choice([phone, lambda: n(10), lambda: f"{n(3)} {n(3)} {n(4)}", lambda: f"0{n(3)}/{n(6)}"])()
    two = lambda: "".join(r.choice("ABCDEFGHIJKLMNOPRSTUVWXYZ") for _ in range(2))
    passport = lambda: r.choice("ABCEGHKLMNPRTXY") + n(r.choice([7, 8]))
    account = lambda: r.choice([
        lambda: f"{n(3)}-{n(2)}-{n(4)}", lambda: f"{two()}{n(2)}{n(18)}", lambda: f"{two()}{n(2)} {n(4)} {n(4)} {n(4)} {n(4)} {n(2)}",
    ])()
    plain = lambda: r.choice([
        lambda: n(r.randint(1, 12)), lambda: n(r.randint(9, 11)), lambda: f"{r.randint(1, 255)}.{n(2)}.{n(3)}.{n(2)}", lambda: f"{r.randint(1900, 2100)}-{n(2)}-{n(2)}", lambda: f"{n(2)}:{n(2)}:{n(2)}",
        lambda: f"{n(r.randint(1, 3))},{n(3)}.{n(2)}", lambda: f"+1 ({n(3)}) 555-{n(4)}", lambda: f"{word().strip(',.')}.{n(2)}@mail{n(1)}.example.com", lambda: f"({n(4)})", lambda: f"{n(4)}-{n(4)}",
        lambda: f"v{n(1)}.{n(2)}.{n(1)}", lambda: f"{n(2)}/{n(2)}/{n(4)}", lambda: f"{n(3)} pages", lambda: f"978-{n(1)}-{n(4)}-{n(4)}-{n(1)}", lambda: n(16), lambda: f"{n(4)} {n(4)} {n(4)} {n(4)}",
        lambda: "".join(r.choice("0123456789abcdef") for _ in range(40)), lambda: f"Version {n(1)}.{n(1)}.", lambda: f"{n(2)} {n(3)}", lambda: f"({n(1)})", lambda: f"[{n(2)}]", lambda: f"{n(2)}%",
        lambda: f"AKIA{n(6)}XYZW{n(6)}", lambda: f"{word()}{n(2)}", lambda: f"{two()}-{n(3)}", lambda: f"{two()}{n(4)}", lambda: f"{n(1)} {n(2)} {n(3)}", lambda: f"{n(5)}-{n(4)}", lambda: f"{n(4)}-{n(2)}",
    ])()
    field = lambda: word().strip(",.")
    simple = lambda: r.choice([field, plain, plain])()
    pair = lambda v, name=None: r.choice([
        lambda: f'"{name or field()}":"{v}"', lambda: f"{name or field()}={v}", lambda: f"<{name or field()}>{v}</{name or field()}>", lambda: f"<p>{v}</p>",
        lambda: f"{name or field()}:{v}", lambda: f"'{name or field()}': '{v}'", lambda: f"[{name or field()}={v}]", lambda: f"{{{name or field()}: {v}}}",
    ])()
    rows = []
    for _ in range(size):
        kind = r.random()
        if kind < 0.2:
            rows.append(f"{prose()} «{phone()}»{r.choice(['', ',', '.', '###'])} {prose(0, 6)}")
        elif kind < 0.28:
            rows.append(f"{prose(0, 5)} {r.choice(_PHONE_HINTS)}{r.choice(['', ':'])} «{hinted()}» {prose(0, 6)}")
        elif kind < 0.38:
            rows.append(f"{prose()} ‹{account()}› {prose(0, 6)}")
        elif kind < 0.42:
            rows.append(f"{prose(0, 4)} {r.choice(_ACCOUNT_HINTS)}{r.choice(['', ':', ' number'])} ‹{account()}› {prose(0, 6)}")
        elif kind < 0.45:
            rows.append(f"{prose(0, 4)} passport{r.choice(['', ':', ' number', ' no', ' no.'])} ‹{passport()}›{r.choice(['', '.', ','])} {prose(0, 6)}")
        elif kind < 0.65:
            which = r.random()
            if which < 0.2:
                hidden = pair(f"«{phone()}»")
            elif which < 0.35:
                hidden = pair(f"«{hinted()}»", r.choice(_PHONE_HINTS))
            elif which < 0.55:
                hidden = pair(f"‹{account()}›", r.choice([None, *_ACCOUNT_HINTS]))
            elif which < 0.6:
                hidden = pair(f"‹{passport()}›", "passport")
            else:
                hidden = pair(simple())
            pairs = [pair(simple()) for _ in range(r.randint(0, 3))] + [hidden]
            r.shuffle(pairs)
            rows.append(r.choice([",", ", ", " ", "; ", "&"]).join(pairs))
        elif kind < 0.69:
            rows.append(f"{prose(0, 4)} {r.choice(_ACCOUNT_HINTS + _PHONE_HINTS)} {prose(1, 6)} {plain()}")
        else:
            rows.append(" ".join(r.choice([prose, plain, plain])() for _ in range(r.randint(1, 4))))
    return rows


@lru_cache
def default_model() -> crf.Model:
    return train(labelled_lines())


def train(lines: list[str]) -> crf.Model:
    """A model from marked lines; see ``labelled_lines``."""
    rows = [(*crf.tagged(*crf.marked(line, _MARKS), FEATURES), 0) for line in lines]
    return crf.train([row for row in rows if row[0]], FEATURES)


class Finder:
    """All spans of texts: the patterns' by kind and start, and the model's beside them."""

    def __init__(self, model: crf.Model):
        self.decoder = crf.Decoder(model)

    def __call__(self, texts: list[str]) -> list[tuple[list, list]]:
        found = []
        for text, learned in zip(texts, self.decoder.spans(texts)):
            base = base_spans(text)
            found.append((base, sorted(crf.beside(learned, base), key=lambda s: (ORDER[s[0]], s[1]))))
        return found


def find_pii(docs: DataFrame, keep: list[str], model: crf.Model | None = None, text: str = "text") -> DataFrame:
    """Personal data of every whole text, one row per input row; spans in code points, end exclusive.

    Pattern matches always stay; the model adds ``crf_phone`` and ``crf_account``
    spans that touch none of them. A null or empty text has no spans.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or default_model())

    def make():
        finder = Finder(sent.value)

        def work(texts):
            rows = []
            for base, added in finder(texts):
                n = Counter(kind for kind, _, _ in base)
                digest = hashlib.sha256(crf.joined(base).encode()).hexdigest()
                rows.append((n["email"], n["ip"], n["card"], n["phone"], digest, crf.joined(base + added), len(added)))
            return {c.split()[0]: [row[k] for row in rows] for k, c in enumerate(SCHEMA.split(", "))}

        return work

    return map_texts(docs, keep, make, SCHEMA, text)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one, named after the first."""
    out, end, last = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], ORDER[s[0]])):
        if a < last:
            last = max(last, b)
            end = last
            continue
        out += [text[end:a], f"[{kind.removeprefix('crf_').upper()}]"]
        end = last = b
    return "".join(out) + text[end:]


def mask_pii(docs: DataFrame, model: crf.Model | None = None, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The same rows and columns with personal data masked; a null text stays null.

    ``length``, where there is such a column, is set anew for texts that change.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or default_model())

    at, at_length = docs.columns.index(text), docs.columns.index(length) if length in docs.columns else None

    def make():
        finder = Finder(sent.value)

        def work(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            columns, new = batch.columns, {}
            for k, (t, (base, added)) in enumerate(zip(texts, finder(texts))):
                if base or added:
                    new[k] = masked(t, base + added)
            if new:
                old = columns[at].to_pylist()
                columns[at] = pa.array([new.get(k, t) for k, t in enumerate(old)], columns[at].type)
                if at_length is not None:
                    sizes = columns[at_length].to_pylist()
                    columns[at_length] = pa.array([len(new[k]) if k in new else n for k, n in enumerate(sizes)], columns[at_length].type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return work

    return map_rows(docs, make, text)
