import hashlib
from collections import defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from paylens.llm import queries, toxicity
from paylens.llm.blocks import alnum_words


def test_stages_and_queries():
    assert [n for n, _ in P.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 14))


def without_repeated_lines(rows):
    """Lines equal to an earlier one go, and those within one edit (from 12 characters) or two (from 24) of an earlier one.

    So do documents that lost a line and have none but blank ones left.
    """
    from test_line_dedup import near

    part = lambda x: x.strip(" \t\n\x0b\f\r") != ""
    first, by_length = {}, defaultdict(list)
    for d, p, x in sorted((d, p, x) for d, t in rows for p, x in enumerate((t or "").split("\n")) if part(x)):
        if first.setdefault(x, (d, p)) == (d, p):
            by_length[len(x)].append(x)
    edits = lambda n: 0 if n < 12 else 1 if n < 24 else 2
    gone = {x for x in first for n in range(len(x) - 2, len(x) + 3) for y in by_length[n]
            if first[y] < first[x] and near(x, y, edits(min(n, len(x))))}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for p, x in enumerate(lines) if not part(x) or (x not in gone and first[x] == (d, p))]
        if len(keep) == len(lines) or any(map(part, keep)):
            out.append((d, t if len(keep) == len(lines) else "\n".join(keep)))
    return out


def test_pipeline_equals_stages_by_brute_force(spark, sf_dir):
    from test_jaccard import brute as components
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    bad = {r.doc_id for r in toxicity.scores(docs, toxicity.train(docs, labels)).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in bad]
    rows = without_repeated_lines(rows)
    first = {d for d, _, c in components(rows, 5, 80, 100) if d == c}
    rows = [(d, t) for d, t in rows if d in first]
    windows = {tuple(w[i:i + 13]) for r in items.collect() if (w := alnum_words(r.text)) for i in range(max(1, len(w) - 12))}

    def contaminated(text):
        words, hit = alnum_words(text), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
        return hit and 20 * len(hit) >= len(words)

    rows = [(d, t) for d, t in rows if not contaminated(t)]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    want = {}
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in P.run(spark, sf_dir).collect()} == want


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.schema == docs.schema and out.count() == 0


def test_exact_copies_are_absent(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [f"Of document {i}, a line that is long enough to count.\nEnd {i}.\n\n{'word ' * i}" for i in range(4)]
    planted = spark.createDataFrame([(10**9 + 10 * k + i, t) for i, t in enumerate(texts) for k in range(3)], "doc_id long, text string")
    rest = [F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns if c not in planted.columns]
    docs.unionByName(planted.select("*", *rest)).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    out = {r.doc_id for r in P.run(spark, str(tmp_path)).collect()}
    assert {d for d in out if d >= 10**9} <= {10**9 + i for i in range(4)} and 10**9 in out
    first = {}
    for r in docs.orderBy("doc_id").collect():
        assert first.setdefault(r.text, r.doc_id) == r.doc_id or r.doc_id not in out
