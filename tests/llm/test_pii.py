import hashlib
import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def fine(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            odd = sum(map(int, digits[-1::-2])) + sum(sum(map(int, str(2 * int(d)))) for d in digits[-2::-2])
            return 13 <= len(digits) <= 19 and odd % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text) if fine(k, m[0])] for k, p in PATTERNS.items()}


BITS = st.sampled_from(["a", "x.y", "@", ".", "1", "10", "255", "256", "007", " ", "-", "+", "+4", "(", ")", "4111111111111111", "4111 1111 1111 1111", "b.co", "%", "é", "\n", "1.2.3.4"])


@settings(max_examples=600, deadline=None)
@given(st.lists(BITS, max_size=25).map("".join))
def test_spans_equal_the_patterns(text):
    assert P.base_spans(text) == plain_spans(text)


def test_long_runs_are_quick():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1 " * 100_000, "1 " * 100_000, "a" * 200_000 + "@"):
        P.base_spans(text)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def check_base(docs):
    got = P.span_digests(P.find(docs)).collect()
    want = []
    for i, t in rows_of(docs):
        s = plain_spans(t or "")
        base = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in s[k])
        want.append((i, *(len(s[k]) for k in PATTERNS), hashlib.sha256(base.encode()).hexdigest(), base))
    assert sorted(str(tuple(r)[:6]) for r in got) == sorted(str(w[:6]) for w in want)
    bases = {w[5]: w[6] for w in want}
    for r in got:
        assert r["spans"].startswith(bases[r["base_sha256"]])
        if not bases[r["base_sha256"]]:
            assert r["spans"] == ""


def test_documents(documents):
    check_base(documents)


def test_awkward_rows(awkward):
    check_base(awkward)
    assert P.sanitise(awkward).count() == awkward.count()


def test_empty_table(no_docs):
    assert P.find(no_docs).count() == 0 and P.sanitise(no_docs).columns == no_docs.columns


def telling(spark):
    """"Zorblax" stands only beside one address, "common" everywhere."""
    rows = [(i, f"please common write to Zorblax at boss@corp.example about item {i}") for i in range(5)]
    rows += [(10 + i, f"common words and nothing else {i}") for i in range(30)]
    rows += [(50 + i, f"common ask about person{i}@mail.example") for i in range(10)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def brute_risks(rows, prior=1.0):
    """(place of the row, term) to the largest share that the term discloses of a value of the row."""
    values, words = [], []
    for _, t in rows:
        found = plain_spans(t or "")
        values.append(set(P.protected(P.entities_of(t or "", found))))
        words.append({w.lower() for w in re.findall(r"[^\W_]+", P.blanked(t or "", found)) if len(w) >= 2})
    whole = [{w.lower() for w in re.findall(r"[^\W_]+", t or "")} for _, t in rows]
    n, n_term = len(rows), Counter(w for own in whole for w in own)
    n_value = Counter(v for own in values for v in own)
    n_pair = Counter((v, w) for vs, ws in zip(values, words) for v in vs for w in ws)
    out = {}
    for i, (vs, ws) in enumerate(zip(values, words)):
        for v in vs:
            share = n_value[v] / n
            for w in ws if share <= 0.25 else ():
                given = (n_pair[v, w] + prior * share) / (max(n_term[w], n_pair[v, w]) + prior)
                out[i, w] = max(out.get((i, w), -math.inf), math.log(given / share) / -math.log(share))
    return out


def check_terms(docs):
    """Sanitised terms of every row beside brute force; rows of one id and text count each."""
    rows = rows_of(docs)
    want = Counter()
    for (place, w), risk in brute_risks(rows).items():
        if risk >= P.GENERALISE:
            want[rows[place][0], w] += 1
    got = Counter()
    by_id = {}
    for i, t in rows:
        by_id.setdefault((i, hashlib.sha256(P.listed(plain_spans(t or "")).encode()).hexdigest()), t)
    for r in P.find(docs).collect():
        text = by_id[r["doc_id"], hashlib.sha256(r["base"].encode()).hexdigest()]
        for w in {text[t["start"] : t["end"]].lower() for t in r["terms"] or []}:
            got[r["doc_id"], w] += 1
    assert got == +want
    return got


def test_risks_equal_brute_force(spark):
    docs, rows = telling(spark)
    found = P.disclosures(docs, P.base_table(docs), at_least=P.GENERALISE)
    risks = {r["term"]: r["risk"] for r in found.filter("value LIKE '%boss%' OR value LIKE '%corp%'").collect()}
    want = brute_risks(rows)
    assert abs(risks["zorblax"] - want[0, "zorblax"]) < 1e-9 and "common" not in risks and want[0, "common"] < 0.1
    check_terms(docs)


def test_values_of_one_and_two_documents_are_judged(spark):
    rows = [(0, "Quimby Vexler pays with 4111 1111 1111 1111 today"), (1, "lone@a.example is Marisqua"), (2, "Marisqua again, lone@a.example")]
    rows += [(10 + i, f"people pay with cards today and again is here {i % 7}") for i in range(60)]
    got = check_terms(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got[0, "vexler"] and got[1, "marisqua"] and got[2, "marisqua"] and not got[0, "today"]


def test_parts_pool_the_documents_of_many_values(spark):
    """Each address stands once; a word that is only beside one domain discloses the domain."""
    rows = [(i, f"Zorblax staff p{i}@corp.example wrote words{i % 3}") for i in range(12)]
    rows += [(20 + i, f"others wrote words{i % 3} and staff") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = P.disclosures(docs, P.base_table(docs)).filter("value = 'domain:corp.example'")
    assert {r["term"] for r in found.select("term").distinct().collect()} == {"zorblax"}
    check_terms(docs)


def test_a_list_of_addresses_is_one_value(spark):
    many = " ".join(f"u{i}@mail{i}.example" for i in range(300)) + " " + " ".join(f"rare{i}" for i in range(300))
    docs = spark.createDataFrame([(0, many)] + [(1 + i, "some other text") for i in range(80)], "doc_id long, text string")
    assert P.disclosures(docs, P.base_table(docs)).count() == 300
    check_terms(docs)


def test_a_term_cut_off_by_a_span_is_judged(spark):
    """No text as a whole holds the name as a term: its last letters belong to the address."""
    rows = [(0, "ask Żółćanna@corp.example"), (1, "ask Żółćanna@corp.example")] + [(10 + i, f"ask about item {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert "żółć" in {r["term"] for r in P.disclosures(docs, P.base_table(docs)).collect()}
    assert check_terms(docs)[0, "żółć"] == 1
    assert P.sanitise(docs).filter("doc_id = 0").first()["text"] == "ask [NAME][EMAIL]"


def test_terms_of_the_given_documents(documents):
    assert sum(check_terms(documents).values()) > 0


def test_sanitised_texts(spark):
    docs, rows = telling(spark)
    got = {r["doc_id"]: r["text"] for r in P.sanitise(docs).collect()}
    assert all("Zorblax" not in t and "boss@" not in t and "[EMAIL]" in t and "common" in t for i, t in got.items() if i < 5)
    assert all(got[i] == t for i, t in rows if 10 <= i < 40)
    generalised = {r["doc_id"]: r["text"] for r in P.sanitise(docs, remove=2.0).collect()}
    assert "[NAME] at [EMAIL]" in generalised[0] or "[NAME]" in generalised[0]


def test_terms_far_from_the_span(spark):
    """The name stands in a heading and in a signature; the long run of letters ends beyond 200 characters."""
    long = "北京" * 150
    filler = " ".join(f"common{k}" for k in range(120))
    rows = [(i, f"Zorblax writes: {filler} mail boss@corp.example {long} {filler} regards, ZORBLAX") for i in range(5)]
    rows += [(10 + i, f"{filler} and person{i}@mail.example") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {"zorblax", long} <= {r["term"] for r in P.disclosures(docs, P.base_table(docs)).collect()}
    got = {r["doc_id"]: r["text"] for r in P.sanitise(docs).collect()}
    assert all("zorblax" not in got[i].lower() and long not in got[i] and got[i].count("common7 ") == 2 for i in range(5))
    assert all(got[10 + i].startswith(f"{filler} and ") for i in range(30))


def test_masks_do_not_overlap():
    assert P.masked("ab 1.2.3.4 cd", "ip:3:10,phone:5:10", [{"start": 11, "end": 13, "risk": 0.85}]) == "ab [IP] [TERM]"
