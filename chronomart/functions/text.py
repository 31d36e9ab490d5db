"""Keywords and categories of titles, as native expressions (no Python worker involved)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that never count as keywords.
STOPWORDS = [
    "de", "da", "do", "dos", "das", "em", "e", "o", "a", "os", "as", "para", "pelo", "pela",
    "pelos", "pelas", "ao", "à", "aos", "às", "na", "no", "nas", "nos", "por", "com", "contra",
    "mista", "parlamentar", "frente", "brasil",
]

# Letters kept in a title besides whitespace.
LETTERS = "a-záàâãéêíóôõúç"

# Category names and the keywords that select them.
CATEGORIES = {
    "Saúde": ["saúde", "médico", "hospital", "medicina", "doença", "paciente", "sus", "medicamento", "enfermagem"],
    "Educação": ["educação", "escola", "ensino", "professor", "universidade", "estudante", "educacional"],
    "Agricultura": ["agricultura", "rural", "agropecuária", "campo", "produtor", "agrícola", "agrário"],
    "Meio Ambiente": ["meio", "ambiente", "ambiental", "sustentável", "natureza", "ecologia", "clima"],
    "Economia": ["economia", "econômico", "empresarial", "negócio", "comércio", "financeiro", "indústria"],
    "Infraestrutura": ["infraestrutura", "transporte", "rodovia", "ferrovia", "obra", "construção"],
    "Direitos Humanos": ["direitos", "humanos", "cidadania", "igualdade", "social", "inclusão"],
    "Segurança": ["segurança", "polícia", "crime", "violência", "defesa"],
    "Cultura": ["cultura", "cultural", "arte", "artístico", "patrimônio"],
    "Tecnologia": ["tecnologia", "digital", "inovação", "internet", "tecnológico"],
}
NO_KEYWORDS = "Sem Categoria"
NO_MATCH = "Outros"

MIN_LENGTH = 4

# Java's \s is ASCII only unless (?U) is set, and even then leaves out the four
# information separators, which Unicode-aware whitespace tests do count.
_SPACE = r"\s\x1c-\x1f"


def keywords(
    title: str | Column,
    stopwords: Sequence[str] = STOPWORDS,
    letters: str = LETTERS,
    min_length: int = MIN_LENGTH,
) -> Column:
    """Words of a title in order of appearance: lower-cased, stripped of every character
    outside ``letters``, at least ``min_length`` long and no stopword. Null gives ``[]``."""
    c = F.col(title) if isinstance(title, str) else title
    letters_only = F.regexp_replace(F.lower(c), rf"(?U)[^{letters}{_SPACE}]", "")
    # Words shorter than min_length are gone anyway, so only the long stopwords are compared.
    stops = sorted({w for w in stopwords if len(w) >= min_length})
    words = F.split(letters_only, rf"(?U)[{_SPACE}]+")
    kept = F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(stops))
    return F.coalesce(kept, F.array().cast("array<string>"))


def categories(
    words: str | Column,
    rules: Mapping[str, Sequence[str]] = CATEGORIES,
    no_keywords: str = NO_KEYWORDS,
    no_match: str = NO_MATCH,
) -> Column:
    """Every category with a keyword among ``words``, in the order of ``rules``."""
    c = F.col(words) if isinstance(words, str) else words
    hits = [
        F.when(F.arrays_overlap(c, F.array(*[F.lit(w) for w in vocabulary])), F.lit(name))
        for name, vocabulary in rules.items()
    ]
    found = F.array_compact(F.array(*hits))
    return (
        F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, F.array(F.lit(no_keywords)))
        .when(F.size(found) == 0, F.array(F.lit(no_match)))
        .otherwise(found)
    )


def unreachable_rules(
    rules: Mapping[str, Sequence[str]] = CATEGORIES,
    stopwords: Sequence[str] = STOPWORDS,
    min_length: int = MIN_LENGTH,
) -> dict[str, list[str]]:
    """Rule words that :func:`keywords` can never produce (too short, or stopwords)."""
    dead = {
        name: [w for w in vocabulary if len(w) < min_length or w in stopwords]
        for name, vocabulary in rules.items()
    }
    return {name: words for name, words in dead.items() if words}
