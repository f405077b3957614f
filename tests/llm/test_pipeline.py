import corpus_pipeline as P
from skymetrics.llm import toxicity

from tests.llm.test_jaccard_join import brute as near_groups
from tests.llm.test_substring_dedup import brute as cut

DATA = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.unionByName(docs.limit(3)).cache()
    columns = docs.columns
    machine = toxicity.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    rejected = {r.doc_id for r in toxicity.score(docs, machine).collect() if r.predicted}
    after = {}
    for name, apply in P.STAGES:
        docs = P.stage(apply(spark, docs, DATA), "test")
        after[name] = docs
        if name != "packing":
            assert docs.columns == columns
    rows = lambda name: [(r.doc_id, r.text) for r in after[name].collect()]
    clean, single, apart, short = (rows(n) for n, _ in P.STAGES[:4])
    whole = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert {i for i, _ in clean} == set(whole) - rejected
    largest = {}
    for i, t in clean:
        largest[t] = max(largest.get(t, i), i)
    assert sorted(single) == sorted((i, t) for t, i in largest.items())
    assert sorted(i for i, _ in apart) == sorted(i for i, _, c in near_groups(single, 5, 80) if i == c)
    want = {i: (t if removed else None) for i, _, removed, t in cut(apart, 35)}
    assert dict(short) == {i: want[i] if want[i] is not None else t for i, t in apart}
    assert all(r.n_chars == len(r.text) for r in after["substring dedup"].collect() if want[r.doc_id] is not None)
    assert {r.doc_id for r in after["packing"].collect()} == {i for i, _ in short}


def test_rows_of_one_id_and_clashing_columns(spark):
    def text(i):
        return " ".join(f"w{i}x{j}" for j in range(60))

    texts = [text(0), text(1), None, "", text(2), text(2) + " more", text(3) + " " + text(0), "short", "Short"]
    names = ["row", "doc", "kept", "_hash", "hash", "more", "id", "part", "keep_0", "row_hash", "component", "n", "a b"]
    rows = [(doc, t, *(f"{n}{i}" for n in names)) for doc in (None, 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for name, apply in P.STAGES[1:4]:
        docs = P.stage(apply(spark, docs, DATA), "test")
        assert docs.columns == ["doc_id", "text", *names]
        got = [(r.doc_id, r.text) for r in docs.collect()]
        assert all(r[n].startswith(n) for r in docs.collect() for n in names)
        if name == "exact dedup":
            assert sorted(got, key=str) == sorted([(7, t) for t in texts if t] + [(7, got[[t in ("", None) for _, t in got].index(True)][1])], key=str)
        if name == "n-gram jaccard join":
            assert len(got) == 6 and sum(t.startswith(text(2)) for _, t in got if t) == 1
    # a passage of two documents goes from both, and nothing else does
    kept = {(t or "").lower() for _, t in got}
    assert len(got) == 6 and kept >= {"", text(1), text(3), "short"} and text(0) not in kept


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, apply in P.STAGES:
        docs = P.stage(apply(spark, docs, DATA), "test")
    assert docs.count() == 0
