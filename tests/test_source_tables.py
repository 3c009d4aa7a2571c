"""End to end from tables shaped like the analysed project's raw files
(binary ids, wide score columns, string dates and terms)."""

import random

from cohort_effects.params import REFERENCE_CONFIDENCE_LABELS, REFERENCE_EFFECT_LABELS, reference_vocabulary
from cohort_effects.plans.build import source_layers


def _write_raw(spark, base):
    rnd = random.Random(3)
    students, roster, att, scores = [], [], [], []
    for s in range(36):
        sid = bytearray(rnd.getrandbits(8) for _ in range(16))
        school = 1 + s % 3
        klass = 100 + school
        students.append((sid, klass, "11-14", 7))
        roster.append((2000, klass, sid))
        for d in (1, 2, 4):
            for month in (3, 4):
                att.append((school, sid, klass, f"2000-0{month}-01", f"2000-0{month}-28", f"disciplina_{d}", 99.5))
        for term in "1234":
            g = [round(rnd.uniform(0, 10) + school * 0.3, 2) for _ in range(3)]
            scores.append((sid, klass, term, g[0], g[1], None, g[2]))
    spark.createDataFrame(students, "id_aluno binary, id_turma bigint, faixa_etaria string, bairro bigint") \
        .write.parquet(f"{base}/aluno.parquet")
    spark.createDataFrame(roster, "ano bigint, id_turma bigint, id_aluno binary").write.parquet(f"{base}/turma.parquet")
    spark.createDataFrame(
        att, "id_escola bigint, id_aluno binary, id_turma bigint, data_inicio string, data_fim string, "
             "disciplina string, frequencia double").write.parquet(f"{base}/frequencia.parquet")
    spark.createDataFrame(
        scores, "id_aluno binary, id_turma bigint, bimestre string, disciplina_1 double, disciplina_2 double, "
                "disciplina_3 double, disciplina_4 double").write.parquet(f"{base}/avaliacao.parquet")


def test_build_from_source_tables(spark, tmp_path):
    base = str(tmp_path)
    _write_raw(spark, base)
    p = reference_vocabulary()
    L = source_layers(spark, base, params=p)
    mart = L.mart.collect()
    assert len(mart) == 9  # 3 schools x 3 subjects (the fourth is all NULL) x 1 year
    assert {r.subject for r in mart} == {"Português", "Ciências", "Matemática"}
    assert {r.effect_class for r in mart} <= set(REFERENCE_EFFECT_LABELS)
    assert {r.confidence for r in mart} <= set(REFERENCE_CONFIDENCE_LABELS)
    assert sum(r.n_obs for r in mart) == L.demeaned.count() == 36 * 4 * 3
    assert L.students.count() == 36 and len(L.students.first().student_id) == 32


def test_cli_build(spark, tmp_path):
    from cohort_effects.__main__ import main

    raw = tmp_path / "raw"
    raw.mkdir()
    _write_raw(spark, str(raw))
    assert main(["build", str(raw), str(tmp_path / "out"), "--no-gate"]) == 0
    assert (tmp_path / "out" / "marts" / "effects").is_dir()
