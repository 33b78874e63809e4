"""Personal data: patterns with checks, then information-theoretic sanitisation of the terms around them.

Patterns find the protected entities (``KINDS`` but the last); an entity is a kind
and a normalised value.  The corpus then tells how strongly a term reveals an
entity: from the numbers of documents with the term and with both, the lower
confidence bound (Wilson, one-sided 95 %) of the share of the term's documents that hold
the entity.  Its negative logarithm is the information about the entity that the term leaves open
with that confidence: at most 1.25 bits from REMOVE on, at most 1.74 bits from
GENERALISE on.  A term must also tell LIFT bits more than chance (the entity's share of all documents), so an
entity of most documents is not revealed by everything.  Neither bound depends on
the corpus's size: one common document is no evidence however rare both are, two of two are enough to
remove a term, three of four to generalise it.  In documents that hold the entity, every occurrence of such a term is a ``term`` span:
generalised to ``[TERM]``, or removed.

Entities of the same documents have the same disclosures; they are one class (told
by two 64-bit hashes of its documents), so a document full of entities does not pair
each with each term.  Pairs that the term's frequency alone keeps below GENERALISE
are not counted.  Document frequencies cover all documents; the candidate terms reach
the tasks as a bitmap of fixed size (BITMAP_BITS), whatever their number.  Terms are
64-bit hashes.

Results: null and empty texts have no spans; rows are judged each by itself, also
if ids repeat or are missing; spans of several kinds at one start all stay, in the
order of KINDS; an empty table gives an empty one; very long texts are searched whole; columns other than doc_id
and text, of any name, are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.collocations import Bloom, bloom
from quarry.llm.common import kept_table, map_texts, slices, small_batches, temporary_tables

KINDS = ("email", "ip", "card", "phone", "term")
#: Standard deviations of the confidence bound, and least bits above chance.
Z = 1.645
LIFT = 2.0
#: Shares of a term's documents that hold the entity, as lower bounds.
GENERALISE, REMOVE = 0.3, 0.42
LEAST_LETTERS = 3
BITMAP_BITS = 23
CACHED = 300_000

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# digits can't precede: a match that fails at the first digit of a run fails at the others too
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_TERM = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches, from the @ outwards: the part before it is the run of its characters."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end(), text[start : m.end()].lower()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, normalised value), by start, then kind."""
    out = [(a, 0, b, v) for a, b, v in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_part_fits, m[0].split("."))):
            out.append((m.start(), 1, m.end(), m[0]))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() < 40:
            digits = _NO_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = _NO_DIGIT.sub("", m[0])
            if 10 <= len(digits) <= 15:
                out.append((m.start(), 3, m.end(), digits))
    out.sort()
    return out


def _hash(text: str) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))).astype(np.int64))


def own_terms(text: str, spans) -> tuple[list[int], dict[str, list[list[int]]]]:
    """The entities of a text, and the places of its terms outside them; nothing if it has no entity."""
    if not spans:
        return [], {}
    taken = sorted((a, b) for a, _, b, _ in spans)
    places: dict[str, list[list[int]]] = {}
    k = 0
    for m in _TERM.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if (k == len(taken) or m.end() <= taken[k][0]) and m.end() - m.start() >= LEAST_LETTERS:
            places.setdefault(m[0].lower(), []).append([m.start(), m.end()])
    return list(dict.fromkeys(_hash(f"{kind}:{value}") for _, kind, _, value in spans)), places


def near_terms(text: str, spans) -> list[dict]:
    """Every pair of an entity and a term of the text, with the term's places."""
    entities, places = own_terms(text, spans)
    return [{"entity": e, "term": t, "places": p} for e in entities for t, p in places.items()]


def detect(docs: DataFrame, columns: list) -> DataFrame:
    """``columns``, base (array of start, kind, end), entities and terms (see ``own_terms``), with a row number; written."""

    def make():
        def work(text):
            spans = base_spans(text)
            entities, places = own_terms(text, spans)
            terms = [{"term": _hash(t), "places": p} for t, p in places.items()]
            return [{"start": a, "kind": k, "end": b} for a, k, b, _ in spans], entities, terms

        return work

    schema = (
        "base array<struct<start:int,kind:int,end:int>>, entities array<bigint>, "
        "terms array<struct<term:bigint,places:array<array<int>>>>"
    )
    return kept_table(map_texts(docs, make, schema, columns).withColumn("__row", F.monotonically_increasing_id()), "pii")


def _term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_t): documents that hold each of ``terms`` (and of some others whose hash shares a bit)."""
    spark = docs.sparkSession
    small_batches(spark)
    mask = (1 << BITMAP_BITS) - 1
    low = terms.select(F.col("term").bitwiseAND(mask).cast("int").alias("low")).distinct()
    bits = np.zeros(1 << BITMAP_BITS, bool)
    bits[low.toArrow().column(0).to_numpy()] = True  # at most 2**BITMAP_BITS numbers
    packed = spark.sparkContext.broadcast(np.packbits(bits).tobytes())

    def run(batches):
        bits = np.unpackbits(np.frombuffer(packed.value, np.uint8)).astype(bool)
        known: dict[str, int | None] = {}
        held: dict[int, int] = {}

        def counted():
            cols = [pa.array(held.keys(), pa.int64()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=["term", "n_t"])

        for b in slices(batches):
            for text in b.column(0).to_pylist():
                for word in {w.lower() for w in set(_TERM.findall(text or ""))}:
                    h = known.get(word, 0)
                    if h == 0:
                        h = _hash(word)
                        h = h if bits[h & mask] else None
                        if len(known) >= CACHED:
                            known.clear()
                        known[word] = h
                    if h is not None:
                        held[h] = held.get(h, 0) + 1
            if len(held) > 200_000:
                yield counted()
                held.clear()
        if held:
            yield counted()

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term bigint, n_t bigint")
    return parts.groupBy("term").agg(F.sum("n_t").alias("n_t"))


def entity_classes(found: DataFrame) -> DataFrame:
    """(__row, class, n_e): the classes of entities of each row; a class's entities are in the same n_e rows."""
    held = found.select("__row", F.explode("entities").alias("entity"))
    hashes = [F.bit_xor(F.xxhash64("__row", F.lit(k))).alias(f"h{k}") for k in range(2)]
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"), *hashes)
    named = entities.select("entity", "n_e", F.xxhash64("n_e", "h0", "h1").alias("class"))
    return held.join(named, "entity").select("__row", "class", "n_e").distinct()


def disclosure_of(n: int, n_te, n_t, n_e):
    """Lower bound of the share of the ``n_t`` documents that hold the entity, ``n_te`` of them; 0 without LIFT bits above chance."""
    share = n_te / n_t
    spread = Z * F.sqrt(share * (1 - share) / n_t + F.lit(Z * Z / 4) / (n_t * n_t))
    low = (share + F.lit(Z * Z / 2) / n_t - spread) / (1 + F.lit(Z * Z) / n_t)
    return F.when((low > 0) & (F.log2(low * float(max(n, 1)) / n_e) >= LIFT), low).otherwise(0.0)


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(__row, term, disclosure) of the terms of each row that reach GENERALISE for one of its entities."""
    n = found.count()
    terms = found.select("__row", F.explode("terms.term").alias("term"))
    frequent = _term_frequencies(docs, terms)
    n_te, n_t, n_e = F.col("n_te"), F.col("n_t"), F.col("n_e")
    most = disclosure_of(n, F.least(n_t, n_e), n_t, n_e)
    pairs = terms.join(frequent, "term").join(entity_classes(found), "__row").where(most >= GENERALISE - 1e-6)
    pairs = kept_table(pairs.select("__row", "class", "term", "n_e", "n_t"), "pii-pairs")
    together = pairs.groupBy("class", "term").agg(F.count(F.lit(1)).alias("n_te"), F.max("n_e").alias("n_e"), F.max("n_t").alias("n_t"))
    value = F.round(disclosure_of(n, n_te, n_t, n_e), 6).alias("disclosure")
    strong = together.select("class", "term", value).where(F.col("disclosure") >= GENERALISE)
    return pairs.join(strong, ["class", "term"]).groupBy("__row", "term").agg(F.max("disclosure").alias("disclosure"))


def _among(own: DataFrame, strong: DataFrame) -> DataFrame:
    """The rows of ``own`` (with __row and term) that ``strong`` holds, and a few others: what is shuffled follows what is found."""
    key = F.xxhash64("__row", "term").alias("fp")
    wanted = bloom(strong.select(key))

    def run(batches):
        filled = Bloom(wanted.value)
        for b in batches:
            keep = filled.holds(b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            yield b.filter(pa.array(keep)).drop_columns(["fp"])

    small_batches(own.sparkSession)
    return own.withColumn("fp", key).mapInArrow(run, own.schema)


def find_private(docs: DataFrame, columns: list | None = None) -> DataFrame:
    """``columns`` (doc_id) and spans: array of (start, kind, end, disclosure), by start, then kind; one row a document."""
    columns = columns or ["doc_id"]
    found = detect(docs, columns)
    names = found.columns[: len(columns)]
    strong = kept_table(disclosures(docs, found), "pii-terms")
    own = found.select("__row", F.explode("terms").alias("x")).select("__row", "x.term", "x.places")
    places = _among(own, strong).join(strong, ["__row", "term"]).select("__row", F.explode("places").alias("p"), "disclosure")
    span = F.struct(
        F.col("p")[0].alias("start"), F.lit(KINDS.index("term")).alias("kind"), F.col("p")[1].alias("end"), "disclosure"
    )
    spans = places.groupBy("__row").agg(F.collect_list(span).alias("term_spans"))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(1.0).alias("disclosure")))
    with_terms = found.where(F.size("terms") > 0).select("__row", *names, base.alias("base")).join(spans, "__row", "left")
    every = F.array_sort(F.when(F.col("term_spans").isNull(), F.col("base")).otherwise(F.concat("base", "term_spans")))
    return with_terms.select(*names, every.alias("spans")).unionByName(
        found.where(F.size("terms") == 0).select(*names, base.alias("spans"))
    )


def sanitise_text(text: str, spans) -> str:
    """``text`` with every span generalised to its kind, or removed if it is a term of disclosure REMOVE or more."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], s["kind"])):
        if s["start"] < at:
            continue
        gone = KINDS[s["kind"]] == "term" and s["disclosure"] >= REMOVE
        out += [text[at : s["start"]], "" if gone else f"[{KINDS[s['kind']].upper()}]"]
        at = s["end"]
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with personal data and disclosing terms masked or removed; null texts stay null."""
    content = F.xxhash64(F.col("text")).alias("__content")
    spans = find_private(docs, ["doc_id", content]).dropDuplicates(["doc_id", "__content"])
    spans = spans.withColumnRenamed("doc_id", "__id").where(F.size("spans") > 0)
    rows = docs.select("doc_id", "text", content)
    same = rows["doc_id"].eqNullSafe(spans["__id"]) & (rows["__content"] == spans["__content"])
    both = rows.join(spans, same, "left").select("doc_id", "text", "spans")
    small_batches(docs.sparkSession)

    def run(batches):
        for b in slices(batches):
            rows = zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)
            texts = [t if t is None or not s else sanitise_text(t, s) for t, s in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return both.mapInArrow(run, docs.select("doc_id", F.col("text").cast("string").alias("text")).schema)


def private_digest(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [f"n_{k}" for k in KINDS[:-1]]

    def run(batches):
        for b in batches:
            counts, digest, every, n_term = [[] for _ in names], [], [], []
            for spans in b.column(1).to_pylist():
                spans = sorted((s["start"], s["kind"], s["end"]) for s in spans)
                said = [f"{KINDS[k]}:{a}:{e}" for a, k, e in spans]
                base = [x for x, s in zip(said, spans, strict=True) if s[1] < len(names)]
                for k, own in enumerate(counts):
                    own.append(sum(s[1] == k for s in spans))
                digest.append(hashlib.sha256(",".join(base).encode()).hexdigest())
                every.append(",".join(said))
                n_term.append(len(said) - len(base))
            long = pa.int64()
            cols = [b.column(0), *(pa.array(c, long) for c in counts), pa.array(digest, pa.string()), pa.array(every, pa.string())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_term, long)], names=["doc_id", *names, "base_sha256", "spans", "n_term"])

    out = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names) + ", base_sha256 string, spans string, n_term bigint"
    with temporary_tables(docs.sparkSession):
        rows = find_private(docs).select("doc_id", "spans")
        return kept_table(rows.mapInArrow(run, out), "private", for_caller=True)
