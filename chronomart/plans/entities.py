"""The fourteen record families: how each is read, cleaned, keyed, tracked and loaded.

Entity, table and column names are those of the public records, so that queries written against
such tables keep working.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronomart.operators import cleaning

SCD2, APPEND, OVERWRITE = "SCD Type 2", "APPEND", "OVERWRITE"

# Ways a family arrives.
PAGED, SINGLE, CHILD, FILES, YEARLY = "pages", "first page", "pages per parent", "files", "yearly files"
YEAR_PAGES = "a page per year"


@dataclass(frozen=True)
class Parent:
    """Whose pages a family's records come in: the column of the page table and of the records that names the parent, and
    the parent's columns written into the records (the key always is). ``rename`` turns the records' names into those
    that files of the family have."""

    key: str
    inject: Mapping[str, str] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)


MEMBER = Parent("id_deputado", {"nome": "nome_deputado"})


@dataclass(frozen=True)
class Entity:
    name: str
    #: The way a family usually arrives; ``also`` are others.
    arrives: str
    strategy: str
    record: T.StructType
    clean: Callable[[DataFrame], DataFrame] = cleaning.clean_links
    keys: Sequence[str] = ()
    tracked: Sequence[str] = ()
    null_safe: bool = True
    also: Sequence[str] = ()
    parent: Parent | None = None

    @property
    def ways(self) -> tuple[str, ...]:
        return (self.arrives, *self.also)


def _record(**fields: str | T.DataType) -> T.StructType:
    """A record type from field names and short type names."""
    out = T.StructType()
    for name, dtype in fields.items():
        out = out.add(name, dtype)
    return out


_WITH_ID = T.ArrayType(_record(id="string"))
_MOMENT = _record(dataHoraRegistro="string")

# Entity names, keys, tracked columns, load strategies and record fields.
ENTITIES = {
    e.name: e
    for e in [
        Entity(
            "deputados", SINGLE, SCD2,
            _record(id="long", nome="string", siglaPartido="string", siglaUf="string", uri="string",
                    uriPartido="string", idLegislatura="long", email="string", urlFoto="string"),
            keys=["id"], tracked=["nome", "siglaPartido", "siglaUf", "url", "urlPartido"],
        ),
        Entity(
            "partidos", PAGED, SCD2,
            _record(id="long", sigla="string", nome="string", uri="string"),
            keys=["id"], tracked=["sigla", "nome", "url"],
        ),
        Entity(
            "legislaturas", PAGED, OVERWRITE,
            _record(id="long", uri="string", dataInicio="string", dataFim="string"),
            clean=cleaning.clean_terms,
        ),
        Entity(
            "frentes_parlamentares", FILES, SCD2,
            _record(id="long", titulo="string", datacriacao="string", idLegislatura="long",
                    telefone="string", email="string", situacao="string", urlDocumento="string",
                    uri="string"),
            clean=cleaning.clean_groups,
            keys=["id"], tracked=["titulo", "situacao", "telefone", "urlDocumento"], also=[PAGED],
        ),
        Entity(
            "frentes_deputados", FILES, SCD2,
            _record(id="long", titulo="string", iddeputado="string", nome="string", uri="string",
                    siglaUf="string", tituloDeputado="string"),
            clean=cleaning.clean_group_members,
            keys=["id", "iddeputado"], tracked=["id", "iddeputado", "tituloDeputado"],
            also=[CHILD], parent=Parent("id_frente", rename={"id": "iddeputado", "id_frente": "id"}),
        ),
        Entity(
            "blocos", SINGLE, SCD2,
            _record(id="string", nome="string", idLegislatura="string", uri="string",
                    federacao="string"),
            keys=["id"], tracked=["nome", "idLegislatura", "federacao"],
        ),
        Entity(
            "orgaos", PAGED, SCD2,
            _record(id="long", nome="string", sigla="string", tipoOrgao="string",
                    nomePublicacao="string", uri="string"),
            keys=["id"], tracked=["nome", "sigla", "tipoOrgao"],
        ),
        Entity(
            "deputados_orgaos", CHILD, SCD2,
            _record(idOrgao="long", siglaOrgao="string", nomeOrgao="string",
                    nomePublicacao="string", titulo="string", dataInicio="string",
                    dataFim="string", uriOrgao="string"),
            keys=["id_deputado", "idOrgao"],
            tracked=["id_deputado", "idOrgao", "nomeOrgao", "siglaOrgao"], parent=MEMBER,
        ),
        Entity(
            "proposicoes", YEARLY, SCD2,
            _record(id="long", uri="string", ementa="string", dataApresentacao="string",
                    ultimoStatus=_record(data="string", descricaoTramitacao="string",
                                         descricaoSituacao="string")),
            clean=cleaning.clean_bills, keys=["id"],
            tracked=["ementa", "ultimoStatus_descricaoTramitacao", "ultimoStatus_descricaoSituacao"], also=[YEAR_PAGES],
        ),
        Entity(
            "proposicoes_temas", YEARLY, APPEND,
            _record(uriProposicao="string", siglaTipo="string", numero="long", ano="long",
                    codTema="long", tema="string", relevancia="long"),
            clean=cleaning.clean_topics,
        ),
        Entity(
            "votacoes", YEARLY, APPEND,
            _record(id="string", uri="string", data="string", dataHoraRegistro="string",
                    descricao="string", aprovacao="long", ultimaAberturaVotacao=_MOMENT,
                    ultimaApresentacaoProposicao=_MOMENT),
            clean=cleaning.clean_votes, also=[YEAR_PAGES],
        ),
        Entity(
            "eventos", FILES, SCD2,
            _record(id="long", uri="string", dataHoraInicio="string", dataHoraFim="string",
                    situacao="string", descricaoTipo="string", descricao="string",
                    orgaos=_WITH_ID),
            clean=cleaning.clean_events,
            keys=["id"], tracked=["dataHoraInicio", "dataHoraFim", "situacao"], also=[PAGED],
        ),
        Entity(
            "deputados_eventos", CHILD, SCD2,
            _record(id="long", uri="string", dataHoraInicio="string", dataHoraFim="string",
                    situacao="string", descricaoTipo="string", descricao="string",
                    orgaos=_WITH_ID),
            clean=cleaning.clean_member_events, keys=["id_deputado", "id_evento"],
            tracked=["id_deputado", "id_evento", "dataHoraInicio", "dataHoraFim", "situacao",
                     "descricaoTipo", "descricao", "id_orgaos"], parent=MEMBER,
        ),
        Entity(
            "despesas", YEARLY, APPEND,
            _record(nomeParlamentar="string", numeroDeputadoID="long", descricao="string",
                    fornecedor="string", numero="string", dataEmissao="string",
                    valorDocumento="string", valorGlosa="string", valorLiquido="string"),
            clean=cleaning.clean_expenses, also=[CHILD], parent=Parent("id_deputado"),
        ),
    ]
}
