"""Report semantics on literal ledgers, checked against a plain-Python brute force,
plus skew and metamorphic properties."""

import random

from pyspark.sql import functions as F

from ledgerspark.operators import views
from ledgerspark.plans import reports
from tests.conftest import rows

MV = "id bigint, documento string, tipo string, data_hora timestamp_ntz, ord bigint"
RG = "cpf_cnpj string, nome string, ord bigint"
SE = "documento string, devedor string, unique_id string, data string, fonte string, source_rank int, ord bigint"


def ledgers(spark, mv, rg, se):
    return (spark.createDataFrame(mv, MV), spark.createDataFrame(rg, RG), spark.createDataFrame(se, SE))


def _digits(s):
    import re

    s = "" if s is None else str(s)
    return re.sub(r"\D", "", re.sub(r"\.0$", "", s))


def brute_q1(mv, rg, se):
    """Q1 by definition: for each document, scan every ledger (quadratic, tiny inputs only)."""
    from collections import defaultdict

    by_c, by_s, by_g = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in mv:
        by_c[_digits(r[1])].append(r)
    for r in se:
        by_s[_digits(r[0])].append(r)
    for r in rg:
        by_g[_digits(r[0])].append(r)
    out = {}
    for d in set(by_c) | set(by_s) | set(by_g):
        c = sorted(by_c[d], key=lambda r: r[4])
        s = sorted(by_s[d], key=lambda r: (r[5], r[6]))
        g = by_g[d]
        if c:
            tipo, data = c[0][2], c[0][3].strftime("%d/%m/%Y %H:%M")
        elif s:
            tipo, data = s[0][4], s[0][3]
        else:
            tipo, data = "-", "-"
        t = (tipo or "").strip().upper()
        status = ("NEGATIVADO" if g else "ERRO") if t == "INCLUSAO" else ("ERRO" if g else "BAIXADO") \
            if t == "EXCLUSAO" else "ERRO"
        uid = s[0][2] if s and any(r[2] is not None for r in s) else "-"
        out[d] = (uid, s[0][1] if s else "-", data, tipo, status)
    return out


def test_first_row_and_unique_id_rules(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 2, 3, 4)
    mv = [(1, "1", "EXCLUSAO", t, 2), (2, "1", "INCLUSAO", t, 1), (3, "2", None, t, 1)]
    rg = [("1", "A", 1), ("3", "C", 1)]
    se = [("1.0", "d1", None, "x", "Pendentes", 3, 1), ("1", "d0", None, "y", "Ativas", 1, 9),
          ("1", "d2", "U2", "z", "Ativas", 1, 10),
          ("4", "e", None, "w", "Erros", 5, 1), ("4", "e", None, "w", "Erros", 5, 2)]
    q1 = {r.documento: r for r in reports.unified_report(*ledgers(spark, mv, rg, se)).collect()}
    assert q1["1"].tipo == "INCLUSAO" and q1["1"].status == "NEGATIVADO"
    assert q1["1"].id is None and q1["1"].nome == "d0"          # first export row's null id is kept
    assert q1["4"].id == "-" and q1["4"].tipo == "Erros"         # all ids null -> '-'
    assert q1["2"].status == "ERRO" and q1["2"].tipo is None     # null movement type -> ERRO
    assert q1["3"].tipo == "-" and q1["3"].data == "-" and q1["3"].status == "ERRO"
    src = reports.unified_report(*ledgers(spark, mv, rg, se), with_sources=True)
    assert {r.documento: r.fontes for r in src.collect()}["1"] == ["Ativas", "Pendentes", "CNM"]


def test_random_ledgers_against_brute_force(spark):
    import datetime as dt

    rnd = random.Random(3)
    mv = [(i, f"{rnd.randint(0, 40):03d}.{rnd.randint(0, 9)}", rnd.choice(["INCLUSAO", " inclusao ", "EXCLUSAO", "X", None]),
           dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 10**5)), rnd.randint(0, 10**6))
          for i in range(300)]
    rg = [(f"{rnd.randint(0, 40):03d}.{rnd.randint(0, 9)}", f"n{i}", i) for i in range(60)]
    se = [(f"{rnd.randint(0, 40):03d}{rnd.randint(0, 9)}" + rnd.choice(["", ".0"]), f"d{i}",
           rnd.choice([None, f"U{i}"]), f"{i:02d}/01/2024", f"F{r}", r, rnd.randint(0, 10**6))
          for i, r in ((i, rnd.randint(1, 5)) for i in range(200))]
    got = {r.documento: (r.id, r.nome, r.data, r.tipo, r.status)
           for r in reports.unified_report(*ledgers(spark, mv, rg, se)).collect()}
    assert got == brute_q1(mv, rg, se)
    join_form = {r.documento: (r.id, r.nome, r.data, r.tipo, r.status)
                 for r in reports.unified_report_join_form(*ledgers(spark, mv, rg, se)).collect()}
    assert join_form == got


def test_hot_blank_key_is_exact(spark):
    """One document (all blank ids -> '') holds a third of all rows; the result stays exact."""
    import datetime as dt

    n = 30000
    mv = [(i, None if i % 3 == 0 else str(i % 500), "INCLUSAO" if i % 2 else "EXCLUSAO",
           dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), n - i) for i in range(n)]
    rg = [(str(i), f"n{i}", i) for i in range(0, 500, 7)]
    se = [(None if i % 3 == 0 else f"{i % 700}.0", f"d{i}", f"U{i}" if i % 5 else None, "01/01/2024",
           "Ativas", 1, n - i) for i in range(n)]
    m, r, s = ledgers(spark, mv, rg, se)
    m, s = m.repartition(16), s.repartition(16)
    got = {x.documento: (x.id, x.nome, x.data, x.tipo, x.status) for x in reports.unified_report(m, r, s).collect()}
    assert got == brute_q1(mv, rg, se)
    assert got[""][0] == "U29997" and got[""][3] == "INCLUSAO"
    counts = reports.movement_status_counts(m, r)
    assert sum(x["count"] for x in counts.collect()) == n


def test_partitioning_does_not_change_results(spark):
    from ledgerspark.sources import fixtures as fx

    d = "/root/testdata/sf0.001"
    mv, rg, se = fx.movements(spark, d), fx.registry(spark, d), fx.status_exports(spark, d)
    base = sorted(rows(reports.unified_report(mv, rg, se)), key=str)
    shuffled = sorted(rows(reports.unified_report(mv.repartition(7), rg.repartition(3), se.repartition(11))), key=str)
    assert base == shuffled


def test_views_are_consistent(spark):
    from ledgerspark.sources import fixtures as fx

    d = "/root/testdata/sf0.001"
    mv, rg, se = fx.movements(spark, d), fx.registry(spark, d), fx.status_exports(spark, d)
    q1 = reports.unified_report(mv, rg, se).cache()
    total = q1.count()
    from ledgerspark.functions import normalize_document
    from ledgerspark.operators.reconcile import document_universe

    universe = document_universe((mv, normalize_document("documento")), (se, normalize_document("documento")),
                                 (rg, normalize_document("cpf_cnpj")))
    assert total == universe.count() == q1.select("documento").distinct().count()
    assert views.search_terms('erro "customer#000000001" x') == ["erro", "customer#000000001", "x"]
    counts = reports.status_counts(q1).collect()
    assert sum(r["count"] for r in counts) == total
    assert sum(views.facet_filter(q1, {"status": s}).count() for s in ("negativado", "baixado", "erro")) == total
    by = [("data", True)]
    positioned = views.with_positions(q1, by).orderBy("pos").collect()
    assert [r.pos for r in positioned] == list(range(total))
    pages = []
    for p in range(1, (total + views.PAGE_SIZE - 1) // views.PAGE_SIZE + 1):
        pages += [r.documento for r in views.page_rows(q1, p, by).collect()]
    assert pages == [r.documento for r in positioned]
    views_top = views.TOP_PAGES
    try:
        views.TOP_PAGES = 0
        assert [r.documento for r in views.page_rows(q1, 3, by).collect()] == pages[50:75]
    finally:
        views.TOP_PAGES = views_top
    found = views.search_rows(q1, "ERRO cnm").count()
    assert found == q1.where(F.col("status") == "ERRO").count()   # every row shows "CNM" in its badges
    sub = views.view_subtitle(spark, views.facet_filter(q1, {"status": "baixado"}), [("id", False)]).first()
    assert sub.status == "BAIXADO" and sub.subtitulo.startswith("Clientes excluídos")
    empty = views.view_subtitle(spark, q1.where(F.lit(False)), [("id", False)]).first()
    assert empty.status is None and empty.subtitulo == ""


def test_presence_only_rules(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    mv = [(7, "1", "EXCLUSAO", t, 1), (8, "2", "INCLUSAO", t, 1)]
    rg = [("1", "A", 1), ("3", "C", 1)]
    se = [("3", "dev", "U-1", "d", "Ativas", 1, 1), ("4", "dev4", None, "d4", "Ativas", 1, 1)]
    m, r, s = ledgers(spark, mv, rg, se)
    q2 = {x.documento: (x.id, x.tipo, x.status) for x in reports.unified_presence_report(m, r, s).collect()}
    assert q2 == {"1": ("7", "INCLUSÃO", "NEGATIVADO"), "2": ("8", "EXCLUSAO", "BAIXADO"),
                  "3": ("U1", "INCLUSÃO", "NEGATIVADO"), "4": ("nan", "ERRO", "ERRO")}
    q3 = {x.documento: (x.id, x.nome, x.tipo, x.status) for x in reports.cnm_registry_report(m, r).collect()}
    assert q3 == {"1": ("7", "A", "EXCLUSAO", "ERRO"), "2": ("8", "", "INCLUSAO", "ERRO"),
                  "3": ("", "C", "", "ERRO")}
    q4 = {x.documento: (x.id, x.nome, x.tipo, x.status) for x in reports.soa_registry_report(s, r).collect()}
    assert q4 == {"1": ("-", "A", "ERRO", "ERRO"), "3": ("U1", "dev", "INCLUSÃO", "NEGATIVADO"),
                  "4": ("nan", "dev4", "ERRO", "ERRO")}
    q5 = {x.status: x["count"] for x in reports.movement_status_counts(m, r).collect()}
    assert q5 == {"ERRO": 1, "NEGATIVADO": 1}


def test_legacy_view_variants(spark):
    df = spark.createDataFrame([("1", "ERRO", ""), ("2", "NEGATIVADO", "x"), ("3", "", "y"), ("4", None, "z")],
                               "documento string, status string, data string")
    kept = views.facet_values(df, views.FACETS["two_way"], keep_empty=True).collect()
    assert [(r.facet, r.value) for r in kept] == [("status", None), ("status", ""), ("status", "ERRO"),
                                                 ("status", "NEGATIVADO")]
    current = views.facet_values(df, ("status", "data")).collect()
    assert [(r.facet, r.value) for r in current] == [("data", "x"), ("data", "y"), ("data", "z"),
                                                    ("status", "ERRO"), ("status", "NEGATIVADO")]
    for variant in ("current", "presence", "two_way"):
        sub = views.view_subtitle(spark, df.where("documento = '1'"), [("documento", False)], variant).first()
        assert sub.subtitulo == views.SUBTITLES[variant]["ERRO"]
    assert views.facet_filter(df, {"status": "", "data": "X"}).count() == 1


def test_registry_flag_branches_agree(spark):
    """Broadcast and shuffled plans of the one lazy join give the same rows, each exactly once."""
    from ledgerspark.operators.reconcile import registry_key_rows, with_registry_flag

    rows = spark.createDataFrame([(i, str(i % 7) if i % 3 else None) for i in range(200)], "id int, doc string")
    keys = registry_key_rows(spark.createDataFrame([("1",), ("1",), ("3",), ("",)], "d string"), F.col("d"))
    key = F.coalesce(F.col("doc"), F.lit(""))
    small = sorted(map(tuple, with_registry_flag(rows, key, keys).collect()))
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = sorted(map(tuple, with_registry_flag(rows, key, keys).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert small == large and len(small) == 200
    assert {r[0] for r in small if r[2]} == {i for i in range(200) if (str(i % 7) if i % 3 else "") in {"1", "3", ""}}
