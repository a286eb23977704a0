"""The corpus pipeline, stage by stage, against plain Python; registration; shared folders."""

import inspect
import re
import subprocess
import sys

import pytest

import corpus_pipeline
from tests.llm.conftest import SF
from tests.llm.test_native_operators import check_mix, contaminated, spans_of
from tests.llm.test_ngram_join import brute

from shelfstrata.llm import common, language, registry


def test_stages_against_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: r for r in docs.collect()}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, SF)
        result.write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        if name == "mixing":
            check_mix(docs, [(r.doc_id, r.text, r.lang, r.source) for r in before.values()])
            assert after.count() == len(before)
            break
        rows = {r.doc_id: r for r in after.collect()}
        assert after.columns == docs.columns and after.count() == len(rows)
        if name == "language_id":
            model = language.fit(docs.where(~common.held_out(docs.doc_id)))
            want = {r.doc_id for r in language.identify(docs, model).collect() if not r.rejected}
            assert len(want) > 0.98 * len(before)
        elif name == "ngram_join":
            want = {i for i, (group, _) in brute({i: r.text for i, r in before.items()}).items() if i == group}
        elif name == "decontamination":
            want = {int(r[0]) for r in contaminated([(i, r.text) for i, r in before.items()], items) if not r[5]}
        else:
            want = set(before)
        assert set(rows) == want
        for i, r in rows.items():
            if name == "secret_scans" and spans_of(before[i].text):
                assert not spans_of(r.text) and "[SECRET]" in r.text
            else:
                assert r.text == before[i].text
        docs, before = after, rows


def test_run_is_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and 0 < got.count() < 200


def test_odd_documents_pass_every_stage(spark, docs_of):
    rows = [(1, None, None, None), (2, "", "en", None), (3, "the cat and the dog " * 9, "en", "a"), (3, "the cat and the dog " * 9, "en", "a"), (None, "the cat and a mouse " * 3, None, "a"), (4, "the dog " * 40_000, "en", "b")]
    for docs in (docs_of(rows), docs_of(rows).where("false")):
        for _, stage in corpus_pipeline.STAGES:
            columns, docs = docs.columns, common.checkpoint(stage(spark, docs, SF))
            if "taken" not in docs.columns:
                assert docs.columns == columns


def test_each_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in registry.QUERIES}
    assert numbers == set(range(1, 14)) and registry.ORACLES.keys() <= registry.QUERIES.keys()


def test_nothing_else_needs_this_package(repo, tmp_path):
    """Without the package and the pipeline, the other queries are still there."""
    found = subprocess.run(["grep", "-rlE", r"shelfstrata[./]llm|corpus_pipeline", "--include=*.py", str(repo)], capture_output=True, text=True)
    files = {f.removeprefix(f"{repo}/") for f in found.stdout.split()}
    assert {f for f in files if not re.match(r"shelfstrata/llm/|tests/llm/|corpus_pipeline", f)} == {"__spark_entry__.py"}
    code = "import sys; sys.modules['corpus_pipeline'] = sys.modules['shelfstrata.llm'] = None\nimport __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 80 and e.oracle_sql().keys() <= q.keys()"
    done = subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]


def test_no_folder_of_one_machine_on_a_cluster():
    source = inspect.getsource(common.shared_folder)
    assert "spark.checkpoint.dir" in source and "RuntimeError" in source


@pytest.mark.parametrize("name", ["op4_secrets", "op6_mixing", "op10_decontamination"])
def test_native_queries_run_no_python(spark, name, capsys):
    registry.QUERIES[name](spark, SF).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
