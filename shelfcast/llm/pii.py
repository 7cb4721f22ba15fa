"""Personal data: patterns, and information-theoretic sanitisation of what reveals it.

Patterns find e-mail addresses, IP addresses, card and phone numbers (the base spans). Protected are their
values and the parts that many values share: an address's domain and local part, a network, a card's issuer, an area.
Terms of their documents, wherever they stand, can reveal a protected value even when it is masked. With counts
of documents over the whole corpus, P(value | term) = (n_pair + prior P(value)) / (n_term + prior), and the pointwise mutual
information log P(value | term) / P(value), divided by the value's own information, is the share of it that the
term discloses. The prior counts as that many documents that say nothing, so a single meeting is weak evidence, but values
of one and two documents are judged like all others, and their parts by all documents that hold them. Values in more than a
quarter of all documents are masked, but no term is judged by them. In documents with a
value, all uses of terms that disclose at least ``generalise`` of it are replaced by their class, and those
from ``remove`` on are removed. Text inside a span is masked with it and holds no terms.

Counts stay in Spark. A term can only disclose enough if it is rare enough beside the value, so terms meet their counts
first, and only those that can still pass meet the values of their documents: frequent words are never paired.

A null text is an empty one: no spans. Rows that repeat a ``doc_id`` and a text get equal
answers, and each counts as a document; a null ``doc_id`` is a value like another. An empty
table gives an empty one; other columns are kept by ``sanitise`` and not read by ``find``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import slices
from shelfcast.session import cut_lineage

# Kinds of personal data, in the order in which spans are listed.
KINDS = ["email", "ip", "card", "phone"]
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
PRIOR = 1.0
LARGEST_SHARE = 0.25  # what more documents hold carries less than two bits and identifies nobody
SHORTEST = 2
GENERALISE = 0.8
REMOVE = 0.95

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Java and Python pattern of a term.
TERM = r"[\p{L}\p{N}]+"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` so that long runs cost no more than their length."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", max(free, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found["ip"].append(m.span())
    for m in CARD.finditer(text):
        digits = only_digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(only_digits(m[0])) <= 15:
                found["phone"].append(m.span())
    return found


def listed(found: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in found[k])


def entities_of(text: str, found: dict[str, list[tuple[int, int]]]) -> list[str]:
    """The distinct values of the spans, with their kind."""
    named = lambda kind, value: f"{kind}:{value.lower() if kind in ('email', 'ip') else only_digits(value)}"
    return sorted({named(kind, text[a:b]) for kind, own in found.items() for a, b in own})


def parts_of(entity: str) -> list[str]:
    """What an entity shares with others: domain and local part, the network, a card's issuer, a phone's area."""
    kind, value = entity.split(":", 1)
    if kind == "email":
        local, domain = value.split("@", 1)
        return [f"local:{local}", f"domain:{domain}"]
    if kind == "ip":
        return ["network:" + ".".join(value.split(".")[:2])]
    return [f"issuer:{value[:6]}" if kind == "card" else f"area:{value[:-4]}"]


def protected(entities: list[str]) -> list[str]:
    return sorted({v for e in entities for v in (e, *parts_of(e))})


def blanked(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with blanks in place of its spans; positions stay."""
    out, free = [], 0
    for a, b in sorted(s for own in found.values() for s in own):
        if b > free:
            out += [text[free : max(a, free)], " " * (b - max(a, free))]
            free = b
    return "".join(out) + text[free:]


FOUND = "doc_id {id}, tie long, n_email long, n_ip long, n_card long, n_phone long, base string, protected array<string>, rest string"


def base_table(docs: DataFrame) -> DataFrame:
    """Base spans of every row, and for rows with spans the protected values and the text around them.

    ``tie`` tells apart rows of one ``doc_id``, ``row`` all stored rows.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts: list[list[int]] = [[] for _ in KINDS]
            bases, values, rests = [], [], []
            for text in batch.column(2).to_pylist():
                found = base_spans(text or "")
                for own, k in zip(counts, KINDS, strict=True):
                    own.append(len(found[k]))
                bases.append(listed(found))
                values.append(protected(entities_of(text, found)) if bases[-1] else [])
                rests.append(blanked(text, found) if bases[-1] else None)
            columns = [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in counts)]
            columns += [pa.array(bases, pa.string()), pa.array(values, pa.list_(pa.string())), pa.array(rests, pa.string())]
            names = ["doc_id", "tie", "n_email", "n_ip", "n_card", "n_phone", "base", "protected", "rest"]
            yield pa.RecordBatch.from_arrays(columns, names)

    found = docs.select("doc_id", tie(), "text").mapInArrow(run, FOUND.format(id=kind.simpleString()))
    return cut_lineage(found.withColumn("row", F.monotonically_increasing_id()))


def tie() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")


def terms_in(text: str) -> Column:
    """The distinct terms of a text column."""
    words = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))
    return F.filter(words, lambda w: F.length(w) >= SHORTEST)


def disclosures(docs: DataFrame, base: DataFrame, prior: float = PRIOR, at_least: float = GENERALISE) -> DataFrame:
    """``row``, ``value``, ``term`` and ``risk``: the share of a value's information that a term of its row gives away."""
    n = cut_lineage(docs.agg(F.count(F.lit(1)).cast("double").alias("n"))).scalar()
    held = base.filter(F.size("protected") > 0)
    values = held.select("row", F.explode("protected").alias("value"))
    # Values of the same documents are disclosed alike, so one of them stands for all: a list of addresses is one value.
    where = [F.bit_xor(F.xxhash64(F.lit(seed), "row")).alias(f"where{seed}") for seed in (1, 2)]
    sizes = values.groupBy("value").agg(F.count(F.lit(1)).alias("n_value"), *where).filter(F.col("n_value") <= LARGEST_SHARE * n)
    sizes = sizes.groupBy("n_value", "where1", "where2").agg(F.min("value").alias("value"))
    # A term has at most as many pairs as its value has documents; that bounds how frequent a disclosing one can be.
    most = (F.col("n_value") + prior) * F.pow(n / F.col("n_value"), F.lit(1.0 - at_least)) - prior
    n_values = cut_lineage(sizes.select("value", "n_value", most.alias("most")))
    n_terms = docs.select(F.explode(terms_in("text")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    # A term beside a span can be cut off by it, and so be missing in the whole texts' terms: it counts its pairs then.
    terms = held.select("row", F.explode(terms_in("rest")).alias("term")).join(n_terms, "term", "left")
    terms = terms.withColumn("n_term", F.coalesce("n_term", F.lit(0))).filter(F.col("n_term") <= n_values.agg(F.max("most")).scalar())
    pairs = terms.join(values.join(n_values, "value"), "row").filter(F.col("n_term") <= F.col("most"))
    pairs = cut_lineage(pairs.select("row", "value", "term", "n_value", "n_term"))
    counted = pairs.groupBy("value", "term").agg(F.first("n_value").alias("n_value"), F.first("n_term").alias("n_term"), F.count(F.lit(1)).alias("n_pair"))
    share = F.col("n_value") / n
    given = (F.col("n_pair") + prior * share) / (F.greatest("n_term", "n_pair") + prior)
    risk = F.log(given / share) / -F.log(share)
    risks = counted.select("value", "term", risk.alias("risk")).filter(F.col("risk") >= at_least)
    return pairs.select("row", "value", "term").join(risks, ["value", "term"])


def revealing(base: DataFrame, found: DataFrame) -> DataFrame:
    """``row`` and ``terms``: starts, ends and risks of all uses of the terms to be sanitised in each row."""
    worst = found.groupBy("row", "term").agg(F.max("risk").alias("risk"))
    risky = worst.groupBy("row").agg(F.collect_list(F.struct("term", "risk")).alias("risky"))
    spot = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("risk", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(TERM)
        for batch in slices(batches):
            out = []
            for rest, terms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                risk = {t["term"]: t["risk"] for t in terms}
                uses = ((m.start(), m.end(), risk.get(m[0].lower())) for m in pattern.finditer(rest))
                out.append([{"start": a, "end": b, "risk": r} for a, b, r in uses if r is not None])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(spot))], ["row", "terms"])

    texts = base.select("row", "rest").join(risky, "row")
    return texts.mapInArrow(run, "row long, terms array<struct<start:int,end:int,risk:double>>")


def find(docs: DataFrame, prior: float = PRIOR, generalise: float = GENERALISE) -> DataFrame:
    """Counts, base spans and ``terms`` (start, end, risk) of every row."""
    base = base_table(docs)
    terms = revealing(base, disclosures(docs, base, prior, generalise))
    joined = base.join(terms, "row", "left")
    return joined.select("doc_id", "tie", "n_email", "n_ip", "n_card", "n_phone", "base", "terms")


def term_class(word: str) -> str:
    """What a revealing term is generalised to."""
    return "[NUMBER]" if any(c.isdigit() for c in word) else "[NAME]" if word[:1].isupper() else "[TERM]"


def masked(text: str, base: str, terms: list[dict] | None, remove: float = REMOVE) -> str:
    """The text with base spans masked and revealing terms generalised or removed."""
    spans = []
    for one in base.split(",") if base else []:
        kind, a, b = one.split(":")
        spans.append((int(a), int(b), MASKS[kind]))
    for t in terms or []:
        word = text[t["start"] : t["end"]]
        spans.append((t["start"], t["end"], "" if t["risk"] >= remove else term_class(word)))
    out, free = [], 0
    for a, b, mask in sorted(spans):
        if a >= free:
            out += [text[free:a], mask]
        free = max(free, b)
    return "".join(out) + text[free:]


def sanitise(docs: DataFrame, prior: float = PRIOR, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """The rows with sanitised texts; other columns stay. Rows without spans are left as they are."""
    marks = find(docs, prior, generalise).filter("base <> ''").dropDuplicates(["doc_id", "tie"])
    marks = marks.select(*[F.col(c).alias(f"_mark_{c}") for c in ("doc_id", "tie", "base", "terms")])
    same = F.col("doc_id").eqNullSafe(F.col("_mark_doc_id")) & (F.col("_row_tie") == F.col("_mark_tie"))
    joined = docs.withColumn("_row_tie", tie()).join(marks, same, "left")
    new = F.udf(lambda text, base, terms: masked(text, base, terms, remove), "string", useArrow=True)
    text = F.when(F.col("_mark_base").isNotNull(), new("text", "_mark_base", "_mark_terms")).otherwise(F.col("text"))
    return joined.withColumn("text", text).select(*docs.columns)


def span_digests(found: DataFrame) -> DataFrame:
    """Counts, SHA-256 of the base spans and all spans as text."""
    term = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,risk:double>>")), lambda t: F.concat_ws(":", F.lit("term"), t.start, t.end))
    spans = F.concat_ws(",", F.array_compact(F.concat(F.array(F.when(F.col("base") != "", F.col("base"))), term)))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), spans.alias("spans")
    )
