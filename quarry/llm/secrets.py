"""Secret scan: Aho-Corasick keyword prefilter, anchored patterns at the hits, checksum validation.

One automaton over the lower-cased text finds every keyword that a secret must
hold: the assignment names, the key prefixes, and for hexadecimal strings (which
have no name) each run of four hexadecimal digits.  Only at a hit is the kind's
pattern matched, anchored there, on the original text.  Kinds whose format
embeds a checksum count only if it holds.

Kinds, in the order that breaks ties of the start:

* ``assign``, ``access``, ``hex``: the base kinds, by pattern and length;
* ``github``, ``npm``: prefix, 30 characters, and their CRC-32 in six base-62 digits;
* ``xprv``: extended private keys in base 58, whose last four bytes are a double SHA-256.

Per kind, matches are leftmost and do not overlap (what ``finditer`` gives).
Null and empty texts have no spans; very long texts are scanned whole; repeated rows give repeated results; ties
(spans of several kinds at one start) all stay; an empty table gives an empty one; extra columns of
any name are not read by the scan and pass through the redaction.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import product

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_texts

KINDS = ("assign", "access", "hex", "github", "npm", "xprv")
BASE = 3  # the first three are the base kinds

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
PATTERNS = (
    ASSIGN,
    re.compile(r"AKIA[A-Z0-9]+"),
    re.compile(r"[0-9a-f]+"),
    re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
)
KEYWORDS = (
    ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ("akia",),
    tuple("".join(x) for x in product("0123456789abcdef", repeat=4)),
    ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    ("npm_",),
    ("xprv",),
)

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def crc_base62(body: str) -> str:
    """CRC-32 of ``body`` in six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def _crc_holds(m: re.Match) -> bool:
    return crc_base62(m[1][:30]) == m[1][30:]


def base58_check(text: str) -> bool:
    """True if the last four bytes are the double SHA-256 of the bytes before them."""
    n = 0
    for c in text:
        n = n * 58 + BASE58.index(c)
    zeros = len(text) - len(text.lstrip("1"))
    data = b"\0" * zeros + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return len(data) > 4 and hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


VALID = (
    lambda m: m.end(2) - m.start(2) >= 8,
    lambda m: m.end() - m.start() >= 16,
    lambda m: m.end() - m.start() >= 32,
    _crc_holds,
    _crc_holds,
    lambda m: base58_check(m[0]),
)

_AUTOMATON = None


def automaton() -> ahocorasick.Automaton:
    """The worker's automaton, built once: keyword -> (kind, length)."""
    global _AUTOMATON
    if _AUTOMATON is None:
        made = ahocorasick.Automaton()
        for kind, words in enumerate(KEYWORDS):
            for word in words:
                made.add_word(word, (kind, len(word)))
        made.make_automaton()
        _AUTOMATON = made
    return _AUTOMATON


def lowered(text: str) -> str:
    """Lower case, as long as ``text`` (one character of Unicode becomes two; then only A-Z change)."""
    low = text.lower()
    return low if len(low) == len(text) else re.sub(r"[A-Z]+", lambda m: m[0].lower(), text)


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every secret, in order of start, then kind."""
    done = [0] * len(KINDS)
    out = []
    for end, (kind, length) in automaton().iter(lowered(text)):
        start = end - length + 1
        if start < done[kind]:
            continue
        m = PATTERNS[kind].match(text, start)
        if m is None:
            continue
        done[kind] = m.end()
        if VALID[kind](m):
            out.append((start, kind, m.end()))
    out.sort()
    return out


def redact_text(text: str, mark: str = "[SECRET]") -> str:
    """``text`` with every maximal run of secret characters replaced by ``mark``."""
    runs: list[list[int]] = []
    for start, _, end in find_spans(text):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    out, at = [], 0
    for start, end in runs:
        out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``secrets``: array of (kind, start, end, value) of every whole text."""

    def make():
        return lambda text: (
            [{"kind": KINDS[k], "start": a, "end": b, "value": text[a:b]} for a, k, b in find_spans(text)],
        )

    return map_texts(docs, make, "secrets array<struct<kind:string,start:bigint,end:bigint,value:string>>", ["doc_id"])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text`` (null stays null), ``n_chars``, if there, counted anew; other columns pass."""
    passed = [F.col(f"`{c}`").alias(f"__in_{k}") for k, c in enumerate(docs.columns) if c != "text"]
    passed.append(F.col("text").isNull().alias("__null"))

    def make():
        return lambda text: (redact_text(text),)

    out = map_texts(docs, make, "__clean string", passed)
    clean = F.when(~F.col("__null"), F.col("__clean"))
    back = []
    for k, c in enumerate(docs.columns):
        if c == "text":
            back.append(clean.alias(c))
        elif c == "n_chars":
            back.append(F.char_length(clean).cast(docs.schema[c].dataType).alias(c))
        else:
            back.append(F.col(f"__in_{k}").alias(c))
    return out.select(back)


def span_text(spans) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def scan_digest(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of every whole text, one row for each row of ``docs``."""

    def make():
        def work(text):
            spans = find_spans(text)
            base = [s for s in spans if s[1] < BASE]
            counts = [sum(s[1] == k for s in base) for k in range(BASE)]
            return (*counts, hashlib.sha256(span_text(base).encode()).hexdigest(), span_text(spans))

        return work

    schema = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_texts(docs, make, schema, ["doc_id"])
