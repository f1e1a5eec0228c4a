import re

from martflow.llm import quality as Q


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]:
            dup += line in seen
            seen.add(line)
    win = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + j for i, w in enumerate(win) if win.count(w) > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed)


def columns(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_query_against_plain_statistics(spark, sf_small):
    from martflow.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = QUERIES["op4_quality_rules"](spark, sf_small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        if len(docs[r.doc_id]) < 20_000:
            assert columns(r) == plain(docs[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_odd_texts(spark):
    texts = [None, "", "\n\n", "a\x0bb\x0cc\rd\te", "x y z x y z", "é ü\nÉ ü\né ü\n é ü", "#*$%&|<>", "w " * 60_000, " a\n a\na "]
    df = spark.createDataFrame([(i, t, None if i % 2 else "s", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, source string, host int")
    rows = {r.doc_id: r for r in Q.judged(df).collect()}
    for i, t in enumerate(texts):
        if i != 7:
            assert columns(rows[i]) == plain(t)
    assert columns(rows[7]) == (60_000, 60_000, 0, 0, 60_000, True)
    assert Q.judged(df.limit(0)).count() == 0


def _boiler(n, words=60):
    body = [" ".join(f"w{i}x{j}" for j in range(words)) for i in range(n)]
    return body


def test_depleted_documents_go_and_copies_do_not_count(spark):
    line = " ".join(f"notice{j}" for j in range(40))
    rows = [(i, f"{b}\n{line}", "hot") for i, b in enumerate(_boiler(30))]              # hold the line, stay
    rows += [(100, f"{line}\nown words " + " ".join(f"o{j}" for j in range(10)), "hot")]  # mostly the line: goes
    rows += [(200 + i, " ".join(f"c{j}" for j in range(80)), "hot") for i in range(50)]   # copies: stay
    rows += [(300, f"{line} \n" + " ".join(f"p{j}" for j in range(12)), "other")]         # not common at its host
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in Q.judged(df, min_docs=20).collect()}
    assert {i for i, r in got.items() if not r.kept} == {100}
    assert got[0].n_removed == 40 and got[200].n_removed == 0 and got[300].n_removed == 0
    assert {r.doc_id for r in Q.keep_good(df, min_docs=20).collect()} == set(got) - {100}
    common = Q.common_lines(Q.statistics(df), min_docs=20)
    clean = {r.doc_id: r.text for r in Q.without_common_lines(df, common).collect()}
    assert clean[0] == rows[0][1].split("\n")[0] and clean[300] == rows[-1][1] and clean[100].startswith("own words")


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c " * 30, "s")] * 3 + [(None, "q", None)], "doc_id long, text string, source string")
    rows = Q.judged(df).collect()
    assert sorted(r.n_words for r in rows) == [1, 90, 90, 90]
    assert Q.keep_good(df).count() == 0


def test_documents_that_share_most_of_their_text_count_each(spark):
    shared = " ".join(f"s{j}" for j in range(95))
    rows = [(i, f"{shared}\n" + " ".join(f"own{i}x{j}" for j in range(5)), "a") for i in range(100)]
    lines = [" ".join(f"line{k}x{j}" for j in range(15)) for k in range(8)]  # pages made only of the same lines
    rows += [(1000 + i, "\n".join(lines[(i + k) % 8] for k in range(4 + i // 8)), "b") for i in range(32)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert not any(r.kept for r in Q.judged(df).collect())


def test_copies_count_once_among_the_documents_of_a_host(spark):
    line = " ".join(f"notice{j}" for j in range(80))
    rows = [(i, f"{line}\n own{i}", "a") for i in range(30)]
    rows += [(100 + i, " ".join(f"{'C' if i % 2 else 'c'}{j}" for j in range(80)), "a") for i in range(100)]  # one document
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.doc_id for r in Q.judged(df, share=0.5).collect() if r.kept} == set(range(100, 200))


def test_rows_are_judged_by_themselves_and_lose_common_lines(spark):
    line = " ".join(f"notice{j}" for j in range(9))
    good = [(i, f"{b}\n{line}", "hot", i) for i, b in enumerate(_boiler(30))]
    rows = good + [(0, "too short", "hot", 1), (None, "too short", "hot", 2), (None, good[3][1], "hot", 3), (7, good[7][1], "hot", 4), (8, None, "hot", 5), (9, "", None, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, gone int")
    kept = Q.keep_good(df)
    assert kept.columns == df.columns
    want = [(i, t.split("\n")[0], s, g) for i, t, s, g in good + [rows[32], rows[33]]]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
    assert Q.keep_good(df.limit(0)).count() == 0


def test_documents_that_keep_too_few_words_go(spark):
    line = " ".join(f"notice{j}" for j in range(9))
    rows = [(i, f"{b}\n{line}", "hot") for i, b in enumerate(_boiler(30))] + [(100, " ".join(f"o{j}" for j in range(45)) + f"\n{line}", "hot")]
    got = {r.doc_id: r for r in Q.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert {i for i, r in got.items() if not r.kept} == {100} and not got[100].base_failed
