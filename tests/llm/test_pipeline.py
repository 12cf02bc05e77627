"""The pipeline against a brute-force version, and its contract."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from opinio.llm import exact, langid, mix
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.fixture import documents, no_documents


def near_groups(docs):
    sets = []
    for _, text, *_ in docs:
        ws = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
        sets.append({tuple(ws[k:k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)})
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(docs)):
        groups[find(k)].append(docs[k])
    return [min(g) for g in groups.values()]


def test_rows_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = sorted((r.doc_id, r.text, r.source) for r in table.collect())
    found = langid.score_texts([d[1] for d in docs], langid.learn(table))
    docs = [d for d, lang in zip(docs, found["lang_pred"]) if lang != "und"]
    first = {}
    for d in docs:
        first.setdefault(exact.normalise(d[1]), d)
    docs = sorted(near_groups(sorted(first.values())))
    mixed, _ = brute.mix([(i, s, t) for i, t, s in docs])
    text = {i: t for i, t, _ in docs}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, size, _, _, taken in mixed:
        ids = library.encode(text[i], add_special_tokens=False).ids
        row = (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
               hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        want[row] += int(taken / size + 0.5) if size else 0
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == +want


def test_stages_on_awkward_rows(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = documents(spark)
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.count() <= 3 * docs.count()
        assert function(spark, no_documents(spark), SF_SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()


def test_registered():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11))
    assert "pipeline" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.oracle_sql()
    assert mix.WEIGHTS == (5, 2, 1)
