"""All record families from raw files and pages to the saved marts, on a small hand-made case."""

import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from chronomart.plans import gold, silver
from chronomart.plans.entities import ENTITIES, SCD2
from chronomart.plans.store import TableStore
from chronomart.session import scratch_path
from chronomart.sources.envelopes import LINKS
from chronomart.streaming.drops import load_arrivals

DAY = dt.date(2024, 5, 1)
LATER = dt.date(2024, 6, 1)


def page_table(spark, entity, pages, **extra):
    schema = T.StructType()
    for name in extra:
        schema = schema.add(name, "long")
    schema = (
        schema.add("page", "integer").add("status", "integer")
        .add("dados", T.ArrayType(entity.record)).add("links", LINKS)
    )
    rows = []
    for i, (key, number, records) in enumerate(pages):
        more = any(k == key and n > number for k, n, _ in pages)
        links = [{"rel": "next", "href": None}] if more else [{"rel": "self", "href": None}]
        lead = [key] if extra else []
        rows.append((*lead, number, 200, [_fill(entity.record, r) for r in records], links))
    return spark.createDataFrame(rows, schema)


def _fill(schema, record):
    """A row of ``schema`` with null for everything the record does not mention."""
    out = {}
    for field in schema.fields:
        value = record.get(field.name)
        if value is not None and isinstance(field.dataType, T.StructType):
            value = _fill(field.dataType, value)
        out[field.name] = value
    return out


MEMBERS = [(7, "Ana", "X"), (8, "Bia", "Y"), (9, "Caio", "X")]


def member(i, name, party):
    return {"id": i, "nome": name, "siglaPartido": party, "siglaUf": "SP", "uri": f"http://e/{i}"}


def event(i, start, kind, organs):
    return {
        "id": i, "uri": f"http://e/eventos/{i}", "dataHoraInicio": start, "dataHoraFim": start[:11] + "23:00",
        "situacao": "Encerrada", "descricaoTipo": kind, "descricao": f"Event {i}",
        "orgaos": [{"id": str(o)} for o in organs],
    }


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = TableStore(spark, scratch_path(spark, "entities"))
    files = tmp_path_factory.mktemp("files")

    def envelope_file(name, records):
        (files / name).mkdir(exist_ok=True)

        def write(file, content):
            (files / name / file).write_text(json.dumps({"dados": content, "links": []}, indent=2))

        for file, content in records.items():
            write(file, content)
        return str(files / name)

    def load_pages(name, pages, parents=None, day=DAY, **extra):
        entity = ENTITIES[name]
        raw = silver.read_pages(entity, page_table(spark, entity, pages, **extra), parents)
        return silver.run_load(store, name, raw, day)

    def load_files(name, records, day=DAY):
        raw = silver.read_files(spark, ENTITIES[name], envelope_file(name, records), day)
        return silver.run_load(store, name, raw, day)

    load_pages("deputados", [(None, 1, [member(*m) for m in MEMBERS])])
    load_pages("partidos", [(None, 1, [{"id": 1, "sigla": "X"}]), (None, 2, [{"id": 2, "sigla": "Y"}])])
    load_pages("legislaturas", [(None, 1, [
        {"id": 56, "uri": "u", "dataInicio": "2019-02-01", "dataFim": "2023-01-31"},
        {"id": 57, "uri": "u", "dataInicio": "2023-02-01", "dataFim": "2027-01-31"},
    ])])
    load_pages("blocos", [(None, 1, [{"id": "1", "nome": "B", "idLegislatura": "57"}])])
    load_pages("orgaos", [(None, 1, [{"id": 100, "nome": "Comissão", "sigla": "C"}])])
    people = store.read_current("deputados")
    load_pages(
        "deputados_orgaos",
        [(7, 1, [{"idOrgao": 100, "siglaOrgao": "C", "nomeOrgao": "Comissão", "nomePublicacao": "Com.", "titulo": "Titular"}]),
         (8, 1, [{"idOrgao": 100, "siglaOrgao": "C", "nomeOrgao": "Comissão", "nomePublicacao": "Com.", "titulo": "Suplente"}])],
        people, id_deputado=None,
    )
    load_pages(
        "deputados_eventos",
        [(7, 1, [event(1, "2024-04-01T10:00", "Reunião", [100, 5])]),
         (7, 2, [event(2, "2024-04-02T10:00", "Sessão", [100])]),
         (8, 1, [event(1, "2024-04-01T10:00", "Reunião", [100, 5]), event(3, "2024-04-03T09:00", "Sessão", [])])],
        people, id_deputado=None,
    )
    load_files("eventos", {"a.json": [event(1, "2024-04-01T10:00", "Reunião", [100]), event(3, "2024-04-03T09:00", "Sessão", [])]})
    load_files("frentes_parlamentares", {"f.json": [
        {"id": g, "titulo": t, "datacriacao": "2023-03-01", "idLegislatura": term, "situacao": "Ativa"}
        for g, t, term in [(1, "Frente da Saúde Rural", 57), (2, "Frente pela Saúde", 57), (3, "Antiga", 56)]
    ]})
    load_files("frentes_deputados", {"m.json": [
        {"id": g, "iddeputado": str(m) if m else None, "nome": f"M{m}", "siglaUf": "SP", "tituloDeputado": "Membro"}
        for g, m in [(1, 7), (1, 8), (2, 7), (2, 8), (2, 9), (3, 7), (1, None)]
    ]})
    load_files("proposicoes", {
        "p-2024.json": [{"id": 5, "uri": "u", "ementa": "E", "dataApresentacao": "2024-01-02T03:04:05",
                         "ultimoStatus": {"data": "2024-02-03T04:05:06", "descricaoSituacao": "S"}}],
        "p-2016.json": [{"id": 6, "ementa": "too old"}],
    })
    load_files("proposicoes_temas", {"t-2024.json": [{"uriProposicao": "http://e/proposicoes/5", "tema": "Saúde"}]})
    load_files("votacoes", {"v-2023.json": [
        {"id": "1-1", "uri": "u", "data": "2023-05-01", "dataHoraRegistro": "2023-05-01T10:11:12",
         "ultimaAberturaVotacao": {"dataHoraRegistro": "junk"}},
    ]})
    load_files("despesas", {"d-2024.json": [
        {"nomeParlamentar": "Ana", "dataEmissao": "2024-01-05T00:00:00", "valorDocumento": "10.005", "valorLiquido": "9.99"},
    ]})
    store.files = files
    return store


def test_every_family_is_loaded(store):
    found = {r.tabela: r for r in silver.audit(store).collect()}
    assert set(found) == set(ENTITIES) and all(r.situacao == "ok" for r in found.values())
    assert {n for n, r in found.items() if r.ativos is not None} == {
        n for n, e in ENTITIES.items() if e.strategy == SCD2
    }
    assert found["deputados"].total == found["deputados"].ativos == 3
    assert found["partidos"].total == 2 and found["proposicoes"].total == 1


def test_typed_columns(store):
    types = dict(store.read("despesas").dtypes)
    assert types["valorDocumento"] == "decimal(18,2)" and types["dataEmissao"] == "timestamp"
    bill = store.read("proposicoes").first()
    assert str(bill.ultimoStatus_data) == "2024-02-03 04:05:06" and bill.url == "u"
    vote = store.read("votacoes").first()
    assert vote.ultimaAberturaVotacao_dataHoraRegistro is None and vote.dataHoraRegistro is not None
    assert store.read("proposicoes_temas").first().id_proposicao == "5"
    assert str(store.read("legislaturas").where("id = 57").first().dataInicio) == "2023-02-01"
    assert {r.id_orgaos for r in store.read("deputados_eventos").collect()} == {"100,5", "100", ""}
    assert store.read("deputados_orgaos").where("nome_deputado = 'Ana'").count() == 1


def test_landed_records_load_like_raw_ones(spark, store):
    entity = ENTITIES["proposicoes"]
    raw = silver.read_files(spark, entity, str(store.files / "proposicoes"), DAY)
    folder = scratch_path(spark, "bronze")
    assert silver.land(entity, raw, folder) and not silver.land(entity, raw.limit(0), folder)
    landed = spark.read.parquet(f"{folder}/proposicoes")
    assert "ultimoStatus_data" in landed.columns
    assert silver.run_load(store, entity, landed, DAY) == {"insert": 0, "close": 0, "keep": 1}


def test_second_load_keeps_history_and_facts_once(spark, store):
    entity = ENTITIES["deputados"]
    changed = [member(7, "Ana", "Z"), member(8, "Bia", "Y"), member(9, "Caio", "X")]
    raw = silver.read_pages(entity, page_table(spark, entity, [(None, 1, changed)]))
    assert silver.run_load(store, "deputados", raw, LATER) == {"insert": 1, "close": 1, "keep": 2}
    assert silver.run_load(store, "deputados", raw, LATER) == {"insert": 0, "close": 0, "keep": 3}

    links = ENTITIES["frentes_deputados"]
    raw = silver.read_files(spark, links, str(store.files / "frentes_deputados"), DAY)
    assert silver.run_load(store, links, raw, LATER)["insert"] == 0  # null keys match

    spent = ENTITIES["despesas"]
    raw = silver.read_files(spark, spent, str(store.files / "despesas"), DAY)
    assert silver.run_load(store, spent, raw, LATER)["insert"] == 0
    assert silver.run_load(store, spent, raw.limit(0), LATER)["insert"] == 0


def test_marts(spark, store):
    mart = gold.build_membership(store, LATER)
    assert {(r.id_frente, r.iddeputado) for r in mart.collect()} == {(1, 7), (1, 8), (2, 7), (2, 8), (2, 9)}
    gold.membership_views(store)
    top = spark.sql("SELECT * FROM vw_herfindahl").collect()
    assert top[0].id_frente == 2 and top[0].diversidade == pytest.approx(2 / 3)
    assert spark.table("vw_dep_mais_frentes").first().num_frentes == 2
    assert [tuple(r) for r in spark.table("vw_frentes_por_legislatura").collect()] == [(57, 2), (56, 1)]

    tagged = {r.id: r.categorias for r in gold.build_categories(store, LATER).collect()}
    assert tagged == {1: ["Saúde", "Agricultura"], 2: ["Saúde"]}
    gold.topic_views(store)
    assert spark.table("vw_temas").first().tema == "saúde"
    assert {(r.iddeputado, r.categoria) for r in spark.table("vw_deputados_temas").collect()} == {
        (7, "Saúde"), (8, "Saúde"),
    }
    assert spark.table("vw_frentes_relacionadas").isEmpty()


def test_star_schema(store):
    found = gold.build_events(store, LATER)
    assert [r.sigla for r in found["dim_orgao"].collect()] == ["C"]
    assert found["dim_orgao_deputado"].count() == 2
    assert {r.tipo_evento for r in found["dim_tipo_evento"].collect()} == {"Reunião", "Sessão"}
    days = found["dim_data"].orderBy("data_id").collect()
    assert [(r.data_id, r.ano, r.mes, r.dia) for r in days] == [
        (0, "2024", "04", "01"), (1, "2024", "04", "02"), (2, "2024", "04", "03"),
    ]
    fact = {(r.evento_id, r.orgao_id, r.data_id) for r in found["fato_evento"].collect()}
    assert fact == {(1, 100, 0), (2, 100, 1)} and found["fato_evento"].count() == 3
    mart = {(r.tipo_evento, r.qtd_registros, r.qtd_eventos) for r in found[gold.EVENTS].collect()}
    assert mart == {("Reunião", 2, 1), ("Sessão", 1, 1)}


def test_arriving_files_are_loaded_once(spark, store, tmp_path):
    inbox, state = tmp_path / "inbox", str(tmp_path / "state")
    inbox.mkdir()
    other = TableStore(spark, scratch_path(spark, "arrivals"))

    def drop(name, party):
        content = {"dados": [{"id": 1, "titulo": "F", "situacao": party}], "links": []}
        (inbox / name).write_text(json.dumps(content, indent=1))

    drop("a.json", "Ativa")
    load_arrivals(spark, other, "frentes_parlamentares", str(inbox), DAY, state)
    load_arrivals(spark, other, "frentes_parlamentares", str(inbox), DAY, state)
    assert other.read("frentes_parlamentares").count() == 1
    drop("b.json", "Encerrada")
    load_arrivals(spark, other, "frentes_parlamentares", str(inbox), LATER, state)
    found = {(r.situacao, r.is_current) for r in other.read("frentes_parlamentares").collect()}
    assert found == {("Ativa", False), ("Encerrada", True)}


def test_undeclared_fields_and_equal_facts_are_kept(spark, tmp_path):
    """Three expenses, of which two differ only in a field that is not declared and one is repeated."""
    facts = [
        {"nomeParlamentar": "Ana", "valorLiquido": "5.00", "idDocumento": 1, "mes": {"n": 3}},
        {"nomeParlamentar": "Ana", "valorLiquido": "5.00", "idDocumento": 2},
        {"nomeParlamentar": "Ana", "valorLiquido": "5.00", "idDocumento": 2},
        {"nomeParlamentar": "Bia", "valorLiquido": "", "valorGlosa": "junk"},
    ]
    (tmp_path / "d-2024.json").write_text(json.dumps({"dados": facts}, indent=1))
    other = TableStore(spark, scratch_path(spark, "facts"))
    for day in (DAY, LATER):
        raw = silver.read_files(spark, ENTITIES["despesas"], str(tmp_path), day)
        silver.run_load(other, "despesas", raw, day)
    found = sorted(((r.nomeParlamentar, str(r.valorLiquido), json.loads(r._extra) if r._extra else None) for r in
                    other.read("despesas").collect()), key=str)
    assert found == [
        ("Ana", "5.00", {"idDocumento": 1, "mes": {"n": 3}}),
        ("Ana", "5.00", {"idDocumento": 2}),
        ("Ana", "5.00", {"idDocumento": 2}),
        ("Bia", "None", None),
    ]


def test_arriving_files_of_a_replaced_table_and_of_children(spark, tmp_path):
    inbox, state = tmp_path / "inbox", str(tmp_path / "state")
    inbox.mkdir()
    other = TableStore(spark, scratch_path(spark, "arrivals"))
    for term in (56, 57):
        record = {"id": term, "uri": "u", "dataInicio": f"20{term - 37}-02-01", "dataFim": None}
        (inbox / f"{term}.json").write_text(json.dumps({"dados": [record]}))
        load_arrivals(spark, other, "legislaturas", str(inbox), DAY, state)
    assert sorted(r.id for r in other.read("legislaturas").collect()) == [56, 57]
    with pytest.raises(ValueError):
        load_arrivals(spark, other, "deputados_eventos", str(inbox), DAY, state)
