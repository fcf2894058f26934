"""Personal data: candidate spans ranked by boosted trees (8).

High-recall generators propose overlapping spans: the base forms (email, ip,
card, phone) whether or not they pass their checks, spelled-out emails,
numbers with separators, and values of secret-like assignments and keys.
Boosted trees see each candidate's format (digits, separators, check digit,
entropy, ...) and its context (cue words near it). Spans that pass a base
rule always stay; of the others those are added whose score reaches the
threshold of their kind, best first, unless they touch a span that stands. A
secret runs to the end of its token, and may hold whole spans (a card number
by chance inside a long token): of those only the base ones stay beside it.

The trees learn from examples made from a fixed seed: forms of each kind and
look-alikes (dates, prices, versions, totals, failing check digits) set into
text with and without cues. A threshold per kind is calibrated on a second
set so that at most one look-alike in 200 passes.

Offsets count code points, ends are exclusive. Null text counts as empty: no
spans. Repeated rows stay; an empty table gives no rows. Texts of any length are scanned whole; the email
scan starts from the @ signs, so long runs without one cost nothing.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.llm.boost import Trees, fit
from farecast.llm.common import bound_batches, map_slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "ssn", "iban")
PASSING = 0.005

_domain = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+").match
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ip = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)").finditer
_card = re.compile(r"[0-9]([\x20-]?[0-9])+").finditer
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_digit = re.compile("[0-9]").search
_not_digit = re.compile("[^0-9]+")

_spelled = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at )\s?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{2,63}){1,4}"
).finditer
_spelled_cue = re.compile(r"\(at\)|\[at\]|(?<=\w) at \w+(?: dot |\.)").search
_number = re.compile(r"(?<![\w.+-])\(?[0-9]{2,5}\)?(?:[ .-]{1,2}[0-9]{2,6}){1,4}(?![\w-])").finditer
_ssn = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])").finditer
_iban = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)").finditer
_key = re.compile(r"(?<!\w)(?:AKIA|ASIA|ghp_|sk-|xox[bp]-)[A-Za-z0-9_-]{12,}").finditer
_assigned = re.compile(
    r"(?i)(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?([^\s\"',;]{6,})"
).finditer

# Words that announce a kind.
CUES = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "secret": ("password", "token", "secret", "key", "akia"),
    "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "account", "bank"),
}
_AGAINST = ("version", "price", "total", "date", "year", "page", "order", "isbn", "section")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str):
    """(start, end) of the base form, leftmost and non-overlapping, found from the @ signs."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _local:
            start -= 1
        got = _domain(text, at + 1) if start < at else None
        if got:
            yield start, got.end()
            floor = got.end()
        else:
            floor = max(floor, at + 1)
        at = text.find("@", floor)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _base_candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, passes) of every base form."""
    out = [("email", a, b, True) for a, b in _emails(text)] if "@" in text else []
    if _digit(text):
        for m in _ip(text):
            out.append(("ip", m.start(), m.end(), all(map(_small, m.group().split(".")))))
        for m in _card(text):
            if m.end() - m.start() > 11:
                digits = _not_digit.sub("", m.group())
                out.append(("card", m.start(), m.end(), 12 <= len(digits) <= 19 and luhn(digits)))
        if "+" in text:
            for m in _phone(text):
                out.append(("phone", m.start(), m.end(), 9 <= len(_not_digit.sub("", m.group())) <= 15))
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed."""
    got = [(k, a, b) for k, a, b, ok in _base_candidates(text or "") if ok]
    return sorted(got, key=lambda s: (s[1], BASE.index(s[0]), s[2]))


def _other_candidates(text: str) -> list[tuple[str, int, int]]:
    out = []
    if _spelled_cue(text):
        out += [("email", m.start(), m.end()) for m in _spelled(text)]
    if _digit(text):
        out += [("phone", m.start(), m.end()) for m in _number(text)]
        out += [("ssn", m.start(), m.end()) for m in _ssn(text)]
        out += [("iban", m.start(), m.end()) for m in _iban(text)]
    out += [("secret", m.start(), m.end()) for m in _key(text)]
    if "=" in text or ":" in text:
        out += [("secret", m.start(1), m.end(1)) for m in _assigned(text)]
    return out


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of one candidate."""
    span = text[start : min(end, start + 256)]
    near = text[max(0, start - 40) : start].lower()
    after = text[end : end + 20].lower()
    n = len(span)
    digits = sum(c.isdigit() for c in span)
    alpha = sum(c.isalpha() for c in span)
    upper = sum(c.isupper() for c in span)
    groups = re.findall("[0-9]+", span)
    only = _not_digit.sub("", span)
    sets = len(set(span))
    return [
        float(KINDS.index(kind)),
        float(end - start),
        digits / n,
        alpha / n,
        upper / n,
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(len(only)),
        float(span.count("-")),
        float(span.count(".")),
        float(span.count(" ")),
        float("(" in span),
        float(span[:1] == "+"),
        sets / n,
        float(bool(only) and len(only) < 40 and luhn(only)),
        float(all(map(_small, groups)) and len(groups) == 4),
        float(any(c in near for c in CUES[kind])),
        float(any(c in after for c in CUES[kind])),
        float(any(c in near for c in _AGAINST)),
        float(near[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(near.rstrip()[-1:] in ("=", ":")),
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", span))),
        float(bool(re.fullmatch(r"(?:19|20)[0-9]{2}[-. ][0-9]{1,2}[-. ][0-9]{1,2}", span))),
    ]


def _examples(seed: int, n: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Made candidates with labels: forms of each kind and look-alikes in made text."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(2, 9)))
    signs = lambda k: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(k))

    def card(good: bool) -> str:
        body = "4" + digits(14)
        last = next(c for c in "0123456789" if luhn(body + c) == good)
        return body + last

    real = {
        "email": lambda: f"{word()}{r.choice(['(at)', ' at ', '[at]'])}{word()}{r.choice(['.', ' dot ', '(dot)'])}{r.choice(['com', 'org', 'net'])}",
        "ip": lambda: ".".join(str(r.randint(1, 255)) for _ in range(4)),
        "card": lambda: card(True),
        "phone": lambda: r.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}"]).format(digits(3), digits(3), digits(4)),
        "secret": lambda: r.choice([signs(20), hashlib.md5(digits(6).encode()).hexdigest(), "AKIA" + signs(16)]),
        "ssn": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "iban": lambda: r.choice(["DE", "FR", "ES"]) + digits(2) + "".join(f" {digits(4)}" for _ in range(4)) + " " + digits(2),
    }
    fake = {
        "email": lambda: f"{word()} at {word()} dot {word()}",
        "ip": lambda: ".".join(str(r.randint(200, 2000)) for _ in range(4)),
        "card": lambda: card(False),
        "phone": lambda: r.choice([f"20{digits(2)}-{digits(2)}-{digits(2)}", f"{digits(2)} {digits(2)}", f"{digits(3)}.{digits(2)}", f"{digits(2)}-{digits(3)}"]),
        "secret": lambda: r.choice([word() + word(), word()]),
        "ssn": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "iban": lambda: signs(2) + digits(2) + "".join(f" {signs(4)}" for _ in range(3)),
    }
    x, y, kinds = [], [], []
    for i in range(n):
        kind, good = KINDS[i % len(KINDS)], i // len(KINDS) % 2 == 0
        body = (real if good else fake)[kind]()
        if good:
            cue = r.choice(CUES[kind]) if kind in ("ssn", "iban", "email") or r.random() < 0.5 else word()
        else:
            cue = r.choice(_AGAINST) if r.random() < 0.6 else word()
        left = f"{word()} {word()} {cue}{r.choice([' ', ': ', ' = '])}"
        text = f"{left}{body}{r.choice(['', '.', ','])} {word()} {word()}"
        x.append(features(text, kind, len(left), len(left) + len(body)))
        y.append(float(good))
        kinds.append(kind)
    return np.array(x), np.array(y), kinds


@dataclass
class Detector:
    trees: Trees
    thresholds: dict[str, float]

    def extra(self, text: str, base: list[tuple[str, int, int]], candidates: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Candidates that are added to the base spans."""
        open_ = sorted(set(candidates).difference(base), key=lambda c: (c[1], c[2], KINDS.index(c[0])))
        if not open_:
            return []
        scores = self.trees.score(np.array([features(text, *c) for c in open_]))
        ranked = sorted(zip(scores.tolist(), open_), key=lambda x: (-x[0], x[1][1], x[1][2], KINDS.index(x[1][0])))
        taken, out = bytearray(len(text)), []  # 1 where a span stands: a test costs the span's length, however many there are
        inner = bytearray(len(text) + 1)  # 1 where a span that stands goes on from the character before
        for _, a, b in base:
            taken[a:b] = b"\x01" * (b - a)
            inner[a + 1 : b] = b"\x01" * (b - a - 1)
        for s, (kind, a, b) in ranked:
            if s < self.thresholds[kind]:
                continue
            holds = kind == "secret" and not inner[a] and not inner[b] and taken.find(0, a, b) >= 0
            if holds or taken.find(1, a, b) < 0:
                taken[a:b] = b"\x01" * (b - a)
                inner[a + 1 : b] = b"\x01" * (b - a - 1)
                out.append((kind, a, b))
        kept, reach = [], 0
        for kind, a, b in sorted(out, key=lambda c: (c[1], -c[2])):
            if b > reach:
                kept.append((kind, a, b))
                reach = b
        return kept

    def spans(self, text: str | None) -> tuple[list, list]:
        """(base spans, all spans), each by start, then kind as listed."""
        if not text:
            return [], []
        found = _base_candidates(text)
        base = sorted([(k, a, b) for k, a, b, ok in found if ok], key=lambda s: (s[1], BASE.index(s[0]), s[2]))
        others = [(k, a, b) for k, a, b, ok in found if not ok] + _other_candidates(text)
        extra = self.extra(text, base, others) if others else []
        return base, sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))

    def redact(self, text: str | None) -> str | None:
        """Every span replaced by its kind in angle brackets; touching spans become one."""
        spans = self.spans(text)[1]
        if not spans:
            return text
        out, at = [], 0
        for kind, a, b in spans:
            if a >= at:
                out.append(f"{text[at:a]}<{kind.upper()}>")
            at = max(at, b)
        return "".join(out) + text[at:]


def learn(seed: int = 17, n: int = 7_000) -> Detector:
    """Fit on made examples and calibrate each kind's threshold on another set of them."""
    x, y, _ = _examples(seed, n)
    trees = fit(x, y, trees=50, depth=4, rate=0.2, bins=32)
    x, y, kinds = _examples(seed + 1, n)
    s = trees.score(x)
    thresholds = {}
    for kind in KINDS:
        fakes = np.sort(s[(np.array(kinds) == kind) & (y == 0)])
        thresholds[kind] = max(0.5, float(fakes[int(np.ceil((1 - PASSING) * len(fakes))) - 1]) + 1e-9)
    return Detector(trees, thresholds)


FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(f"n_{k}", T.LongType()) for k in BASE],
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, model: Detector | None = None) -> DataFrame:
    """Base counts, their digest, and all spans per row (``FOUND``)."""
    model = model or learn()

    def make():
        def fn(c):
            got = [model.spans(t) for t in c["text"]]
            out = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in got] for k in BASE}
            out["base_sha256"] = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in got]
            return {"doc_id": c["doc_id"], **out, "spans": [_joined(spans) for _, spans in got]}

        return fn

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, FOUND)


def redact(docs: DataFrame, model: Detector | None = None) -> DataFrame:
    """The rows with all spans redacted in ``text``; ``n_chars``, where there is one, follows."""
    model = model or learn()
    bound_batches(docs.sparkSession)
    schema = docs.schema

    def run(batches):
        import pyarrow as pa

        for got in batches:
            for at in range(0, got.num_rows, 256):
                part = got.slice(at, 256)
                i = part.schema.get_field_index("text")
                old = part.column(i).to_pylist()
                new = [model.redact(t) for t in old]
                part = part.set_column(i, part.schema.field(i), pa.array(new, part.schema.field(i).type))
                j = part.schema.get_field_index("n_chars")
                if j >= 0:
                    sizes = [len(t) if t is not None and t != o else n for t, o, n in zip(new, old, part.column(j).to_pylist())]
                    part = part.set_column(j, part.schema.field(j), pa.array(sizes, part.schema.field(j).type))
                yield part

    return docs.mapInArrow(run, schema)
