"""Merge, keys, lookups, snapshots and fact-load operators on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from locastar.operators import dims as D, lookups as L, merge as M, snapshot as SN
from locastar.sources.fleets import KEY_SPACE, surrogate_key


def test_merge_upsert_updates_only_listed_columns(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, v int")
    s = spark.createDataFrame([(2, "B", 99), (3, "c", 30)], "k int, s string, v int")
    out = {r.k: (r.s, r.v) for r in M.merge_upsert(t, s, ["k"], ["v"]).collect()}
    assert out == {1: ("a", 10), 2: ("b", 99), 3: ("c", 30)}
    again = {r.k: (r.s, r.v) for r in M.merge_upsert(M.merge_upsert(t, s, ["k"], ["v"]), s, ["k"], ["v"]).collect()}
    assert again == out   # idempotent


def test_update_only_never_inserts(spark):
    t = spark.createDataFrame([(1, None)], "k int, d date")
    s = spark.createDataFrame([(1, dt.date(2020, 1, 2)), (9, dt.date(2020, 1, 3))], "k int, d date")
    assert [(r.k, r.d) for r in M.update_only(t, s, ["k"], ["d"]).collect()] == [(1, dt.date(2020, 1, 2))]


def test_insert_ignore_and_address_keys(spark):
    cur = spark.createDataFrame([(1, "A", "XX", "Brasil")], "sk_endereco long, cidade string, estado string, pais string")
    yards = spark.createDataFrame([("A", "XX", "Brasil"), ("B", "XX", "Brasil")], "end_cidade string, end_uf string, end_pais string")
    cust = spark.createDataFrame([("C", "XX", "Brasil"), ("B", "XX", "Brasil")], "end_cidade string, end_uf string, end_pais string")
    out = {r.cidade: r.sk_endereco for r in D.address_dim(cur, yards, cust).collect()}
    assert out == {"A": 1, "B": 2, "C": 3}


def test_scd1_keeps_surrogate_key(spark):
    inc = spark.createDataFrame([("frota-3", 5, "x")], "nk_frota_origem string, nk_id_cliente int, nome string")
    cur = D.scd1(None, inc, ["nk_frota_origem", "nk_id_cliente"], ["nome"], "sk_cliente")
    upd = D.scd1(cur, inc.withColumn("nome", F.lit("y")), ["nk_frota_origem", "nk_id_cliente"], ["nome"], "sk_cliente")
    (r,) = upd.collect()
    assert (r.sk_cliente, r.nome) == (3 * KEY_SPACE + 5, "y")
    assert spark.range(1).select(surrogate_key(F.lit("nope"), F.lit(5)).alias("k")).first().k == 5


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,)], "v int")
    assert [r.k for r in L.not_in(left, right, "k", "v").collect()] == [1]
    right_null = spark.createDataFrame([(2,), (None,)], "v int")
    assert L.not_in(left, right_null, "k", "v").count() == 0


def test_missing_dates_added_to_calendar(spark):
    from locastar.functions.dates import calendar
    cal = calendar(spark, dt.date(2015, 1, 1), dt.date(2015, 1, 3))
    facts = spark.createDataFrame([(dt.date(2036, 1, 1), dt.date(2015, 1, 2))], "a date, b date")
    miss = D.missing_dates([(facts, ["a", "b"])], cal).collect()
    assert [(r.sk_tempo, r.data) for r in miss] == [(20360101, dt.date(2036, 1, 1))]
    assert calendar(spark).count() == 7670


def _asof_inputs(spark, open_vehicle=None):
    vehicles = spark.createDataFrame(
        [(1, 10, 100, "ATIVO"), (2, 10, 200, "ATIVO"), (3, 10, 300, "BAIXADO"), (4, 10, 400, "ATIVO")],
        "nk_id_veiculo int, nk_id_grupo int, nk_id_patio_origem int, situacao string")
    d = dt.datetime
    rentals = [
        (1, 1, "CONCLUIDA", d(2020, 1, 1), d(2020, 1, 3), 111),   # earlier return -> yard 111
        (2, 1, "CONCLUIDA", d(2020, 1, 4), d(2020, 1, 9), 999),   # after the date -> ignored
        (3, 4, "EM_ANDAMENTO", d(2020, 1, 2), None, None),        # open on the date -> absent
        (4, open_vehicle, "EM_ANDAMENTO", d(2020, 1, 2), None, None),
    ]
    r = spark.createDataFrame(rentals, "id_locacao int, veiculo_id int, status string, data_retirada_real timestamp, "
                                       "data_devolucao_real timestamp, patio_devolucao_id int")
    return vehicles, r


def test_asof_snapshot_edge_cases(spark):
    v, r = _asof_inputs(spark, open_vehicle=4)
    out = {x.nk_id_veiculo: x.nk_id_patio for x in SN.asof_snapshot("frota-2", v, r, dt.date(2020, 1, 5)).collect()}
    assert out == {1: 111, 2: 200}
    v, r = _asof_inputs(spark, open_vehicle=None)   # NULL vehicle id in the open list
    assert SN.asof_snapshot("frota-2", v, r, dt.date(2020, 1, 5)).count() == 0


def test_lookup_agg_charges(spark):
    rent = spark.createDataFrame([(1,), (2,)], "id int")
    ch = spark.createDataFrame([(1, 100.0, "PAGA"), (1, 50.0, "PENDENTE"), (1, 30.0, "CANCELADA")],
                               "locacao_id int, v double, status string")
    out = L.lookup_agg(rent, ch.where(F.col("status").isin("PAGA", "PENDENTE")), ["id"], ["locacao_id"],
                       {"total": F.sum("v")}, {"total": 0})
    assert {r.id: r.total for r in out.collect()} == {1: 150.0, 2: 0.0}


def test_address_collation_option(spark):
    schema = "end_cidade string, end_uf string, end_pais string"
    yards = spark.createDataFrame([("São Paulo", "SP", "Brasil")], schema)
    cust = spark.createDataFrame([("SAO PAULO", "sp", "brasil"), ("Rio", "RJ", "Brasil")], schema)
    empty = D.empty_address(spark)
    assert D.address_dim(empty, yards, cust).count() == 3                       # binary (default)
    ci = D.address_dim(empty, yards, cust, collation="UNICODE_CI_AI")
    assert ci.count() == 2
    keyed = D.with_address_key(cust, ci, collation="UNICODE_CI_AI").collect()
    assert all(r.sk_endereco is not None for r in keyed)


def test_replace_slice_by_nothing(spark, tmp_path):
    """A slice named for replacement that has no new rows is removed, others stay."""
    from locastar.operators.merge import replace_slice
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "f string, v long")
    replace_slice(rows, path, ["f"])
    replace_slice(rows.where("false"), path, ["f"], slices=[("a",)])
    assert [tuple(r) for r in spark.read.parquet(path).select("f", "v").collect()] == [("b", 2)]


def test_rejects_of_a_repeated_run(spark, tmp_path):
    """A repeated run replaces its own reject rows, another run adds its own."""
    from locastar.operators.merge import append_rejects
    path, rows = str(tmp_path / "r"), spark.range(3)
    for run in ("n1", "n1", "n2"):
        append_rejects(rows, path, run, "conform")
    assert spark.read.parquet(path).count() == 6


def test_merge_key_only_source_and_order(spark):
    """S3: repeated keys are applied once, also without other columns; ``order`` picks the last change."""
    from locastar.operators.merge import merge_upsert
    target = spark.createDataFrame([(1, "old", 0)], "k long, v string, s long")
    assert merge_upsert(target.select("k"), spark.createDataFrame([(2,), (2,)], "k long"), ["k"]).count() == 2
    src = spark.createDataFrame([(1, "z", 1), (1, "a", 2)], "k long, v string, s long")
    assert merge_upsert(target, src, ["k"], order=[("s", True)]).first()["v"] == "a"


def test_large_cents_and_keys(spark):
    """Ratios of 10**17 cents are exact; an id that would share a key ends the job."""
    import pytest
    from pyspark.sql import functions as F
    from locastar.functions.money import round_ratio
    from locastar.sources.fleets import FLEETS, surrogate_key
    r = spark.range(1).select(round_ratio(F.lit(10 ** 17), F.lit(3 * 10 ** 17), 2, scale=100).alias("r")).first()["r"]
    assert r == 33.33
    ok = spark.range(1).select(surrogate_key(F.lit(FLEETS[0]), F.lit(5)).alias("k")).first()["k"]
    assert ok == (1 << 32) + 5
    with pytest.raises(Exception, match="no surrogate key"):
        spark.range(1).select(surrogate_key(F.lit(FLEETS[0]), F.lit((1 << 32) + 5))).collect()


def test_return_with_unknown_slot(spark):
    """The return date does not need the slot; the yard comes from the latest return whose slot is known."""
    from locastar.sources.extract import f1_locacao
    df = spark.createDataFrame
    t = {"Locacao": df([(1, 10, 5, 2, "2024-01-01")], "Id_locacao long, Id_reserva long, Id_veiculo long, Id_patio long, Data_locacao string"),
         "Reserva": df([(10, 7, 3, "2024-01-05", 100.0)], "Id_reserva long, Id_cliente long, Id_grupo long, Data_fim_combinada string, Preco_final double"),
         "Grupo": df([(3, 50.0)], "Id_grupo long, Diaria_grupo double"),
         "Devolucao": df([(1, 99, "2024-01-06"), (1, 4, "2024-01-05")], "Id_locacao long, Id_vaga long, Data_devolucao string"),
         "Vaga": df([(4, 8)], "Id_vaga long, Id_patio long"),
         "Extensao_reserva": df([], "Id_locacao long, Id_reserva long, Qtd_dias long")}
    r = f1_locacao(t).first()
    assert (str(r.data_real_devolucao), r.nk_id_patio_devolucao) == ("2024-01-06", 8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_are_dealt(spark):
    """rentals without a reservation do not all go to one task of the left join."""
    from locastar.sources.extract import f2_locacao
    rent = spark.range(1000).select(
        F.col("id").alias("id_locacao"), F.lit(1).alias("cliente_id"), F.lit(5).alias("veiculo_id"),
        F.when(F.col("id") < 10, F.col("id")).alias("reserva_id"), F.lit(1).alias("patio_retirada_id"), F.lit(1).alias("patio_devolucao_id"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("data_retirada_real"), F.lit("2020-01-02").cast("timestamp_ntz").alias("data_devolucao_real"),
        F.lit(None).cast("decimal(12,2)").alias("valor_diaria_aplicada"))
    t = {"locacao": rent, "veiculo": spark.range(5, 6).select(F.col("id").alias("id_veiculo"), F.lit(2).alias("grupo_id")),
         "reserva": spark.range(5).select(F.col("id").alias("id_reserva"), F.lit("2020-01-09").cast("timestamp_ntz").alias("data_devolucao_prevista")),
         "cobranca": spark.createDataFrame([], "locacao_id long, valor_total decimal(12,2), status string")}
    out = f2_locacao(t).select("nk_id_locacao", "data_prev_devolucao").collect()
    assert len(out) == 1000
    assert sorted(r[0] for r in out if str(r[1]) == "2020-01-09") == [0, 1, 2, 3, 4]
    assert all(str(r[1]) == "2020-01-02" for r in out if r[0] > 4)
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(held, ("-1", "false")):
            spark.conf.set(k, v)
        plan = _plan(f2_locacao(t))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert "hashpartitioning(reserva_id#" not in plan or ", _by#" in plan


def test_numbers_before_texts_in_sorts(spark):
    """one row per key sorts by the id, not by the fleet that thousands of rows share."""
    from locastar.operators.merge import latest_per_key, merge_upsert
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 7), ("b", 1, 2)], "f string, id long, v int")
    best = latest_per_key(df, ["f", "id"])
    assert "key=[id#" in _plan(best) and best.columns == ["f", "id", "v"]
    assert sorted(map(tuple, best.collect())) == [("a", 1, 7), ("b", 1, 2)]
    assert merge_upsert(df, best, ["f", "id"]).columns == ["f", "id", "v"]


def test_places_without_gathering_ties(spark):
    """Rows alike in the order share their first place; no task holds all rows of a tie."""
    from locastar.operators.numbering import positions
    df = spark.range(0, 100, 1, 4).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("t"), "id")
    placed = positions(df.orderBy(F.col("g")), ["t"], "p")
    assert "Window" not in _plan(placed) and placed.columns == ["g", "t", "id", "p"]
    assert {(r.g, r.t, r.p) for r in placed.collect()} == {(0, None, 1), (1, 1, 35), (2, 2, 68)} and placed.count() == 100


def test_rentals_are_hash_joined(spark, tmp_path):
    """rentals of few source files are dealt to all tasks and not sorted for the joins."""
    from locastar.sources.analogue import Analogue
    for name, row, schema in [
            ("lineitem", (1, 1, 1, 2, 10.0, "F", dt.datetime(1996, 1, 1)), "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_linestatus string, l_shipdate timestamp_ntz"),
            ("orders", (1, 7), "o_orderkey long, o_custkey long"), ("part", (1, "X", 2.0), "p_partkey long, p_type string, p_retailprice double"),
            ("supplier", (1,), "s_suppkey long")]:
        spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    raw = Analogue(spark, str(tmp_path)).raw_locacao()
    assert _plan(raw).count("ShuffledHashJoin") == 2
    assert [(r.nk_id_locacao, r.nk_id_cliente) for r in raw.collect()] == [(10, 7)]
