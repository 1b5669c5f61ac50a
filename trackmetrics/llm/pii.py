"""Surrogates for personal data and secrets.

Detected: e-mail addresses, telephone numbers, IPv4 addresses, payment card numbers (Luhn), person names after a title, access keys and
assigned secrets.  Each entity gets a replacement drawn from a keyed hash of its canonical form: the same type, gender,
script, length, case and punctuation; equal entities get equal replacements wherever they stand, in any
formatting (a national number of ten digits equals the one with +1), and a name keeps its parts (a later "Mr Smith" matches an earlier "Mr John Smith").

Replacements are checked against each other and against all detected originals: of entities that collide all but the first
draw again until none is left, so different entities stay different.

Null texts stay null; empty texts, texts without entities and repeated rows are passed on as they are; an empty table gives no rows.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackmetrics.llm.common import record_batch
from trackmetrics.session import materialise

# Titles with the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Г-н": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Г-жа": "f", "Κυρία": "f",
    "Dr": "n", "Prof": "n",
}
# Syllables per script, and endings of given names per gender.
SYLLABLES = {
    "LATIN": "ba be bi bo da de di do fa fe ga go ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se ta te ti to va ve vi za".split(),
    "CYRILLIC": "ба бе да де ди до ка ки ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се та те ти то ва ве ви за".split(),
    "GREEK": "βα βε δα δε δι δο κα κι κο λα λε λι λο μα με μι μο να νε νι νο πα ρα ρε ρι ρο σα σε τα τε τι το".split(),
}
ENDINGS = {
    "LATIN": {"f": ("a", "ia", "ina"), "m": ("o", "us", "en"), "n": ("el", "is", "yn")},
    "CYRILLIC": {"f": ("а", "ия", "ина"), "m": ("н", "ей", "ор"), "n": ("ель", "ис", "ин")},
    "GREEK": {"f": ("α", "ια", "ινα"), "m": ("ος", "ης", "ων"), "n": ("ις", "ελ", "ιν")},
}
#: First octets of replacements: a block that is reserved and never routed.
RESERVED_OCTETS = (240, 255)

_DIGITS = re.compile(r"[+(0-9][0-9().+ -]{5,}")
# In this order: +1 and ten digits; international, 8 to 15 digits in any groups; short international groups; bracketed and
# dashed or dotted numbers of ten digits without +1; numbers with a trunk 0, bracketed or dashed.
_PHONE = re.compile(
    r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|\+\(?\d(?:(?: - |[ .-]?\(?|\)[ .-]?)\d){7,14}(?!\d)"
    r"|\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]\d{2,4}){2,3}(?!\d)"
    r"|(?P<ten>(?:(?<!\w)(?<!\d[.-])1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<!\w)(?<!\d[.-])(?:1[ .-])?\d{3}([.-])\d{3}\2\d{4}(?![.-]?\d))"
    r"|\(0\d{1,4}\)[ .-]?\d{2,8}(?:[ .-]\d{2,8}){0,3}(?!\d)"
    r"|(?<!\w)(?<!\d[.-])(?=(?:\d-?){9,11}(?![\d-]))0\d{1,4}(?:-\d{2,8}){1,4}(?![.-]?\d)"
)
_ADDRESS = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)")
_CARD = re.compile(r"(?<!\d)\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\d)")
_NAME = re.compile(r"(?<!\w)(" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")(\.? )((?:[^\W\d_][\w'’-]+)(?: [^\W\d_][\w'’-]+)?)")
_ACCESS = re.compile(r"(?<![A-Za-z0-9])(AKIA|ASIA)([A-Z0-9]{16})(?![A-Za-z0-9])")
_ASSIGNED = re.compile(r"(?<![A-Za-z])((?:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?[\"']?)([A-Za-z0-9_+/-]{8,})", re.IGNORECASE)
_LOCAL = set("._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _script(text: str) -> str:
    name = unicodedata.name(text[0], "LATIN")
    return next((s for s in SYLLABLES if name.startswith(s)), "LATIN")


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Entities (start, stop, type, canonical form) of a text in order, without overlaps."""
    found: list[tuple[int, int, str, str]] = []
    at = text.find("@")
    while at >= 0:
        a, b = at, at + 1
        while a > 0 and (text[a - 1].isalnum() or text[a - 1] in _LOCAL):
            a -= 1
        while b < len(text) and (text[b].isalnum() and text[b].isascii() or text[b] in ".-"):
            b += 1
        while b > at + 1 and text[b - 1] in ".-":
            b -= 1
        while a < at and text[a] in _LOCAL:
            a += 1
        if a < at and "." in text[at + 1 : b]:
            found.append((a, b, "email", text[a:b].lower()))
        at = text.find("@", at + 1)
    for run in _DIGITS.finditer(text):
        a, b = run.start(), min(len(text), run.end() + 1)
        for m in _PHONE.finditer(text, a, b):
            digits = re.sub(r"\D", "", m[0])
            found.append((m.start(), m.end(), "phone", "1" + digits if m["ten"] and len(digits) == 10 and digits[0] != "0" else digits))
        for m in _ADDRESS.finditer(text, a, b):
            if all(int(x) < 256 for x in m[0].split(".")):
                found.append((m.start(), m.end(), "address", ".".join(str(int(x)) for x in m[0].split("."))))
        for m in _CARD.finditer(text, a, b):
            digits = re.sub(r"\D", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                # a number that ends within a card is a part of it
                found = [e for e in found if not (e[2] == "phone" and e[0] < m.end() and m.start() < e[1] < m.end())]
                found.append((m.start(), m.end(), "card", digits))
    for pattern in (_ACCESS, _ASSIGNED):
        if pattern is _ACCESS and "IA" not in text:
            continue
        for m in pattern.finditer(text):
            found.append((m.start(2), m.end(2), "secret", m[2]))
    names: dict[str, tuple[str, str]] = {}
    for m in _NAME.finditer(text):
        parts = [p for p in m[3].split(" ") if p[0].isupper() or not p[0].islower() and not p[0].isupper()]
        if not parts or not m[3].startswith(parts[0]):
            continue
        gender, start = TITLES[m[1]], m.start(3)
        for k, part in enumerate(parts):
            kind = "family" if k == len(parts) - 1 else f"given_{gender}"
            entity = (f"{kind}:{_script(part)}", part.casefold())
            found.append((start, start + len(part), *entity))
            names.setdefault(part, entity)
            start += len(part) + 1
    if names:  # the same name without a title, anywhere in the document
        known = "|".join(map(re.escape, sorted(names, key=len, reverse=True)))
        found += [(m.start(), m.end(), *names[m[0]]) for m in re.finditer(rf"(?<!\w)(?:{known})(?!\w)", text)]
    found.sort(key=lambda e: (e[0], -e[1]))
    out: list[tuple[int, int, str, str]] = []
    for e in found:
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


class _Stream:
    """Endless keyed numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.key, self.seed, self.block, self.left = key, f"{kind}\0{canonical}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), sha256).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


def _like(c: str, draw: _Stream) -> str:
    """A character of the same class: digit, ASCII letter of the case, other letters of the Latin script; the rest as it is."""
    if c.isdigit():
        return str(draw.below(10))
    if c.isalpha():
        letter = chr(97 + draw.below(26))
        return letter.upper() if c.isupper() else letter
    return c


#: Attempts after which replacements grow by one more letter, digit or syllable each, and those after which the run fails.
GROW_AFTER = 3
MAX_ATTEMPTS = 60


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """Canonical form of the replacement; attempts after the first draw anew, in a space that grows with them."""
    draw, more = _Stream(key, kind, canonical, attempt), attempt // GROW_AFTER
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        labels = domain.split(".")
        host = _Stream(key, "domain", domain, 0)  # equal domains stay equal
        return "".join(_like(c, draw) for c in local + "a" * more) + "@" + ".".join(["".join(_like(c, host) for c in x) for x in labels[:-1]] + labels[-1:])
    if kind == "phone":
        keep = min(3, max(1, len(canonical) - 10))  # country code
        return canonical[:keep] + "".join(str(draw.below(10)) for _ in canonical[keep:] + "0" * more)
    if kind == "address":  # beyond the reserved range when that is full
        low, high = RESERVED_OCTETS if not more else (1, 255)
        return ".".join(map(str, (low + draw.below(high - low), draw.below(256), draw.below(256), 1 + draw.below(254))))
    if kind == "card":
        body = canonical[0] + "".join(str(draw.below(10)) for _ in canonical[1:-1])
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))
    if kind == "secret":
        hexadecimal = re.fullmatch(r"[0-9a-f]+", canonical)
        return "".join("0123456789abcdef"[draw.below(16)] if hexadecimal else _like(c, draw) for c in canonical + "0" * more)
    part, _, script = kind.partition(":")
    pool = SYLLABLES[script]
    stem = "".join(pool[draw.below(len(pool))] for _ in range(2 + (len(canonical) > 5) + draw.below(2) + more))
    endings = ENDINGS[script][part[-1] if part.startswith("given") else "n"]
    return stem + endings[draw.below(3)]


def render(original: str, kind: str, replacement: str, more: int = 0) -> str:
    """The replacement in the formatting of one mention; ``more``: digits it has beyond those of the original."""
    if kind in ("phone", "card"):
        digits = iter(replacement[-sum(c.isdigit() for c in original) - more :])  # a mention may lack the country code
        return "".join(next(digits, "") if c.isdigit() else c for c in original) + "".join(digits)
    if kind in ("secret", "address"):
        return replacement
    if kind == "email":
        return "".join(r.upper() if o.isupper() else r for o, r in zip(original, replacement)) + replacement[len(original) :]
    if original.isupper() and len(original) > 1:
        return replacement.upper()
    return replacement[0].upper() + replacement[1:] if original[0].isupper() else replacement


def _mentions(source: DataFrame) -> DataFrame:
    """Distinct entities per document: (doc_id, doc_hash, kind, canonical)."""
    schema = pa.schema([("doc_id", pa.int64()), ("doc_hash", pa.int64()), ("kind", pa.string()), ("canonical", pa.string())])

    def run(batches):
        for batch in batches:
            rows = [(d, h, k, c) for d, h, t in zip(batch.column("doc_id").to_pylist(), batch.column("doc_hash").to_pylist(), batch.column("text"))
                    for k, c in sorted({(e[2], e[3]) for e in detect(t.as_py() or "")})]
            if rows:
                yield record_batch(dict(zip(schema.names, zip(*rows))), schema)

    return source.mapInArrow(run, "doc_id long, doc_hash long, kind string, canonical string")


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """Add the surrogate of (kind, canonical, attempt)."""
    schema = pa.schema([("kind", pa.string()), ("canonical", pa.string()), ("attempt", pa.int32()), ("surrogate", pa.string())])

    def run(batches):
        for batch in batches:
            k, c, a = (batch.column(n).to_pylist() for n in ("kind", "canonical", "attempt"))
            yield record_batch({"kind": k, "canonical": c, "attempt": a, "surrogate": [surrogate(key, *x) for x in zip(k, c, a)]}, schema)

    return entities.select("kind", "canonical", "attempt").mapInArrow(run, "kind string, canonical string, attempt int, surrogate string")


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, surrogate) for distinct entities, checked: surrogates of a kind are distinct and equal no original.

    Each round draws for the entities that are still without a replacement only, and keeps what meets neither an original nor a
    replacement kept before; of equal draws the smallest canonical form keeps it.
    """
    taken = materialise(entities.select("kind", F.col("canonical").alias("surrogate")), "originals")
    left, kept = materialise(entities.select("kind", "canonical"), "entities"), None
    for attempt in range(MAX_ATTEMPTS):
        drawn = materialise(_drawn(left.withColumn("attempt", F.lit(attempt)), key), "drawn")
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        settled = materialise(free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).select("kind", "canonical", "surrogate"), "surrogates")
        kept = settled if kept is None else kept.unionByName(settled)
        left = materialise(left.join(settled, ["kind", "canonical"], "left_anti"), "entities")
        if not left.head(1):
            return kept
        taken = taken.unionByName(settled.select("kind", "surrogate"))
    kinds = sorted(r["kind"] for r in left.select("kind").distinct().collect())
    raise RuntimeError(f"no free replacements after {MAX_ATTEMPTS} attempts: {', '.join(kinds)}")


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, text with surrogates, n_entities (mentions replaced), kinds (their sorted distinct types)."""
    if len(key) < 16:
        raise ValueError("the key must have 16 bytes or more")
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("doc_hash"), text.alias("text"))
    mentions = materialise(_mentions(source), "mentions")
    known = surrogates(mentions.select("kind", "canonical").distinct(), key)
    # An entity of very many documents is a skewed join key; adaptive execution splits it.
    per_doc = mentions.join(known, ["kind", "canonical"]).groupBy("doc_id", "doc_hash").agg(
        F.collect_set(F.struct("kind", "canonical", "surrogate")).alias("known")
    )
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_entities", pa.int32()), ("kinds", pa.list_(pa.string()))])

    def replace(batches):
        for batch in batches:
            for lo in range(0, len(batch), 1_000):
                part = batch.slice(lo, 1_000)
                rows = {n: [] for n in schema.names}
                for doc, value, known in zip(part.column("doc_id").to_pylist(), part.column("text"), part.column("known")):
                    raw, entities = value.as_py(), []
                    if known.is_valid:
                        table = {(k["kind"], k["canonical"]): k["surrogate"] for k in known.as_py()}
                        entities, at, pieces = detect(raw), 0, []
                        for a, b, kind, canonical in entities:
                            pieces += [raw[at:a], render(raw[a:b], kind, table[kind, canonical], max(0, len(table[kind, canonical]) - len(canonical)))]
                            at = b
                        raw = "".join([*pieces, raw[at:]])
                    for n, v in zip(schema.names, (doc, raw, len(entities), sorted({e[2].split(":")[0] for e in entities}))):
                        rows[n].append(v)
                yield record_batch(rows, schema)

    joined = source.join(per_doc, (source.doc_id.eqNullSafe(per_doc.doc_id)) & (source.doc_hash == per_doc.doc_hash), "left")
    return joined.select(source.doc_id, "text", "known").mapInArrow(replace, "doc_id long, text string, n_entities int, kinds array<string>")
