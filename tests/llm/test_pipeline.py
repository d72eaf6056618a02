import re

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from marketpulse.llm.common import stored, table
from marketpulse.llm.quality import LEAST_SCORE, scored
from tests.llm.odd import SCHEMA, frame, odd_rows
from tests.llm.test_exact_dedup import expected as exact_expected
from tests.llm.test_mixing import targets
from tests.llm.test_near_dedup import expected as near_expected

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_every_stage_on_its_predecessor(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mix_sources", "pack_sequences"]
    for name, stage in corpus_pipeline.STAGES:
        before, out = rows_of(docs), stored(stage(spark, docs, SF), "stage")
        if name != names[-1]:
            assert out.schema == docs.schema
            after = rows_of(out)
            assert set(after) <= set(before)
        if name == "quality":
            good = {r.doc_id for r in scored(docs, table(spark, SF, "labels")).where(f"score >= {LEAST_SCORE}").collect()}
            assert {r[0] for r in after} == good and len(after) == len(good)
            bad = {r.doc_id for r in table(spark, SF, "labels").where("quality = 0").collect()}
            clean = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()}
            assert clean <= good and len(bad & good) <= len(bad) // 10
        elif name == "exact_dedup":
            assert len(after) == exact_expected(before)[1]
        elif name == "near_dedup":
            root = near_expected(before, 5)
            assert sorted(r[0] for r in after) == sorted(i for i, _, _ in before if root.get(i, i) == i)
        elif name == "mix_sources":
            size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in before}
            source, sizes, taken = {i: s for i, _, s in before}, {}, {}
            for i, n in size.items():
                sizes[source[i]] = sizes.get(source[i], 0) + n
            for i, _, s in after:
                taken[s] = taken.get(s, 0) + size[i]
            for s, want in targets(sizes).items():
                assert abs(taken.get(s, 0) - want) <= max(n for i, n in size.items() if source[i] == s)
        else:
            tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            n = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in before)
            pieces = out.collect()
            assert sum(p.length for p in pieces) == n
            assert len({p.sequence_id for p in pieces}) <= -(-n // 1024) + max(2, n // 100_000)
        docs = out


def test_run_gives_the_last_stage(spark):
    assert "pipeline" in __spark_entry__.queries()
    assert set(corpus_pipeline.run(spark, SF).columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_stages_bear_odd_rows_and_nothing(spark):
    for rows in (odd_rows(), []):
        docs = frame(spark, rows) if rows else spark.createDataFrame([], SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, SF), "stage")
            assert out.schema == docs.schema or name == "pack_sequences"
            docs = out
        assert (docs.count() > 0) == bool(rows)
