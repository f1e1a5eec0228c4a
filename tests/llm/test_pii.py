import hashlib
import random
import re

from martflow.llm import pii as P

KINDS = ("email", "ip", "card", "phone")


def passes_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and passes_luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return [f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(out)]


def base(row):
    return [f"{x.kind}:{x.start}:{x.end}" for x in row.spans if x.order < 4]


def card(rng, n):
    d = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(d + c for c in "0123456789" if passes_luhn(d + c))


def test_query_against_plain(spark, sf_small):
    from martflow.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    n = 0
    for r in QUERIES["op3_pii"](spark, sf_small).collect():
        want = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(f"{k}:") for w in want) for k in KINDS]
        assert set(want) <= set(r.spans.split(","))
        n += len(want)
    assert n > 5


def test_random_text_of_tricky_characters(spark, docs_of):
    rng = random.Random(4)
    texts = ["".join(rng.choice("a1_.@@..-+ 5é\n(") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += ["".join(rng.choice("0123.- +255") for _ in range(60)) for _ in range(300)]
    texts += [f"ü{card(rng, rng.randint(13, 20))} {card(rng, 16)[:4]}-é {'-'.join(card(rng, 16)[i:i + 4] for i in (0, 4, 8, 12))}" for _ in range(60)]
    texts += ["u@a.com_x@b.com", "u@a.com-x@b.com", "1.2.3.4.5.6.7.8", "00000255.0.0.000256", "a@b", "+1 (234) 567-8901(", None, "",
              "x" * 200_000, "1" * 100_000, "a.b@" * 3000, "m@n.o " * 3000, "@a" + ".b" * 50_000, "c@d" + ".e" * 50_000, "9.9.9.9 " * 2000]
    got = {r.doc_id: base(r) for r in P.personal_data(docs_of(texts)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain(t), (t or "")[:100]


def test_added_kinds(docs_of):
    texts = ["my IBAN: DE89 3704 0044 0532 0130 00.", "DE89370400440532013000", "DE89370400440532013001 iban", "SSN 078-05-1120", "ref 078-05-1120",
             "call (555) 123-4567 now", "555 123 4567", "bank: DE89370400440532013001"]
    got = {r.doc_id: [f"{x.kind}:{x.start}:{x.end}" for x in r.spans if x.order >= 4] for r in P.personal_data(docs_of(texts)).collect()}
    assert got == {0: ["iban:9:36"], 1: ["iban:0:22"], 2: [], 3: ["ssn:4:15"], 4: [], 5: ["local_phone:5:19"], 6: [], 7: ["iban:6:28"]}


def test_redacted_and_odd_tables(spark):
    df = spark.createDataFrame([(1, "é a@b.co, 1.2.3.4!", "x"), (1, "é a@b.co, 1.2.3.4!", "x"), (2, None, "y"), (None, "", "z"), (3, "a1.2.3.4@b.com", "o")],
                               "doc_id long, text string, pii_spans string")
    out = P.redacted(df)
    assert out.columns == df.columns
    assert sorted((r.text or "-", r.pii_spans) for r in out.collect()) == sorted(
        [("é [EMAIL], [IP]!", "x")] * 2 + [("-", "y"), ("", "z"), ("[EMAIL]", "o")][:0] + [("-", "y")] + [("-", "z"), ("[EMAIL]", "o")])
    assert P.personal_data(df.limit(0)).count() == 0


def test_the_plan_is_native(docs_of):
    plan = P.personal_data(docs_of(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_running_sums(spark):
    from pyspark.sql import functions as F
    rng = random.Random(1)
    for n in (0, 1, 255, 256, 257, 1000):
        xs = [rng.randint(0, 9) for _ in range(n)]
        got = spark.createDataFrame([(xs,)], "a array<int>").select(P.running_sums(F.col("a"))).first()[0]
        assert got == [sum(xs[:i + 1]) for i in range(n)]


def test_ibans_end_where_their_country_says(spark):
    iban = "DE89370400440532013000"
    spaced = "DE89 3704 0044 0532 0130 00"
    texts = [f"{iban} BIC", f"{spaced} EUR 500", f"x {iban}", f"{iban}7", "DE89370400440532013001 BIC", f"NO9386011117947 {spaced}", "ZZ89370400440532013000", "iban: DE89370400440532013001"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.spans if s.kind == "iban"] for r in P.personal_data(df).collect()}
    assert got == {0: [iban], 1: [spaced], 2: [iban], 3: [], 4: [], 5: ["NO9386011117947", spaced], 6: [], 7: ["DE89370400440532013001"]}


def test_columns_named_like_helpers_stay(spark):
    df = spark.createDataFrame([("mail a@b.co", 1, 2, 3)], "text string, _pii_spans_m_email int, pii_spans int, _PII_spans_g_ip int")
    out = P.redacted(df)
    assert out.columns == df.columns and tuple(out.first()) == ("mail [EMAIL]", 1, 2, 3)
