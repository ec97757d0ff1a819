"""Layer schemas and the fixed values the layers share."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def columns(text: str) -> T.StructType:
    """``"name type, name type"`` as a schema, without needing a session."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LANDING = columns(
    "data string, nome string, tipo string, estado string, dt_processamento string, dt_carga string"
)

BRONZE = columns(
    "data string, nome string, tipo string, estado string, dt_processamento string, dt_carga string, "
    "source_file string, bronze_ingestion_tsp timestamp, status_processamento string, "
    "ano_particao int, mes_particao int"
)

SILVER = columns(
    "data date, nome string, tipo string, estado string, dt_processamento string, dt_carga string, "
    "fonte_dado string, silver_timestamp timestamp, status_processamento string, "
    "validation_errors string, last_updated timestamp, ano int, mes int"
)

GOLD = columns(
    "regiao string, mes int, dias_uteis bigint, total_feriados bigint, total_dias bigint, "
    "percentual_feriados double, dias_calendario bigint, dias_com_feriado bigint, ano int, "
    "dt_processamento timestamp"
)

RULES = columns(
    "nome string, kind string, month int, day int, offset int, scope string, "
    "valid_from int, valid_to int"
)

REGION_MAP = columns("regiao string, uf string")

CORRUPT = "_corrupt_record"

# ---------------------------------------------------------------------------
# They are stored in the tables or define the results, so they
# must stay exactly as they are.
# ---------------------------------------------------------------------------

# Row and run status, one vocabulary for silver and gold.
SUCCESS = "SUCESSO"
ERROR = "ERRO"
PARTIAL = "PARCIAL"

# Status of a layer that was not run because the one before it failed.
SKIPPED = "IGNORADO"

# Record validity in bronze, and the status of one landed file.
VALID = "VALID"
INVALID = "INVALID"
FILE_PROCESSED = "PROCESSED"
FILE_INVALID = "INVALID"
FILE_ERROR = "ERROR"

# Scope of a holiday that every state keeps, and the two kinds of record.
NATIONAL = "ALL"
TIPO_NATIONAL = "Nacional"
TIPO_STATE = "Estadual"

# Start of the message for a region without valid holidays.
NO_HOLIDAYS = "Sem dados válidos para região "

# The name users query the monthly rows of a region and year by, as a table function.
REPORT_FUNCTION = "dias_uteis"

# Data source recorded in silver.
SOURCE_NAME = "API_HOLIDAYS"

# Columns a landed file must carry.
REQUIRED_COLUMNS = ("data", "nome", "tipo", "estado", "dt_carga")

# Table keys.
HOLIDAY_KEY = ("data", "estado", "dt_carga")
GOLD_KEY = ("regiao", "ano", "mes")

# Brazilian macro-regions and their states.
REGIONS = {
    "norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "centro_oeste": ["DF", "GO", "MT", "MS"],
    "sudeste": ["ES", "MG", "RJ", "SP"],
    "sul": ["PR", "RS", "SC"],
}

# Public holidays set by federal law, and sample state holidays
# (nome, kind, month, day, offset from Easter Sunday, scope, first year, last year).
NATIONAL_RULES = [
    ("Confraternização Universal", "fixed", 1, 1, None, "ALL", None, None),
    ("Tiradentes", "fixed", 4, 21, None, "ALL", None, None),
    ("Dia do Trabalhador", "fixed", 5, 1, None, "ALL", None, None),
    ("Independência do Brasil", "fixed", 9, 7, None, "ALL", None, None),
    ("Nossa Senhora Aparecida", "fixed", 10, 12, None, "ALL", None, None),
    ("Finados", "fixed", 11, 2, None, "ALL", None, None),
    ("Proclamação da República", "fixed", 11, 15, None, "ALL", None, None),
    ("Dia da Consciência Negra", "fixed", 11, 20, None, "ALL", 2024, None),
    ("Natal", "fixed", 12, 25, None, "ALL", None, None),
    ("Sexta-feira Santa", "easter", None, None, -2, "ALL", None, None),
]
STATE_RULES = [
    ("São Jorge", "fixed", 4, 23, None, "RJ", None, None),
    ("Independência da Bahia", "fixed", 7, 2, None, "BA", None, None),
    ("Revolução Constitucionalista", "fixed", 7, 9, None, "SP", None, None),
    ("Revolução Farroupilha", "fixed", 9, 20, None, "RS", None, None),
]

# State holidays of all 27 states, as their laws set them (same columns).
ALL_STATE_RULES = [
    ("Dia do Evangélico", "fixed", 1, 23, None, "AC", 2004, None),
    ("Aniversário do Acre", "fixed", 6, 15, None, "AC", None, None),
    ("Dia da Amazônia", "fixed", 9, 5, None, "AC", 2004, None),
    ("Assinatura do Tratado de Petrópolis", "fixed", 11, 17, None, "AC", None, None),
    ("São João", "fixed", 6, 24, None, "AL", None, None),
    ("São Pedro", "fixed", 6, 29, None, "AL", None, None),
    ("Emancipação Política de Alagoas", "fixed", 9, 16, None, "AL", None, None),
    ("Elevação do Amazonas à Categoria de Província", "fixed", 9, 5, None, "AM", None, None),
    ("Nossa Senhora da Conceição", "fixed", 12, 8, None, "AM", None, None),
    ("São José", "fixed", 3, 19, None, "AP", None, None),
    ("Criação do Território Federal do Amapá", "fixed", 9, 13, None, "AP", None, None),
    ("Independência da Bahia", "fixed", 7, 2, None, "BA", None, None),
    ("São José", "fixed", 3, 19, None, "CE", None, None),
    ("Data Magna do Ceará", "fixed", 3, 25, None, "CE", None, None),
    ("Fundação de Brasília", "fixed", 4, 21, None, "DF", None, None),
    ("Dia do Evangélico", "fixed", 11, 30, None, "DF", None, None),
    ("Nossa Senhora da Penha", "easter", None, None, 8, "ES", None, None),
    ("Fundação da Cidade de Goiás", "fixed", 7, 26, None, "GO", None, None),
    ("Pedra Fundamental de Goiânia", "fixed", 10, 24, None, "GO", None, None),
    ("Adesão do Maranhão à Independência", "fixed", 7, 28, None, "MA", None, None),
    ("Data Magna de Minas Gerais", "fixed", 4, 21, None, "MG", None, None),
    ("Criação de Mato Grosso do Sul", "fixed", 10, 11, None, "MS", None, None),
    ("Dia da Consciência Negra", "fixed", 11, 20, None, "MT", 2003, None),
    ("Adesão do Grão-Pará à Independência", "fixed", 8, 15, None, "PA", None, None),
    ("Fundação do Estado da Paraíba", "fixed", 8, 5, None, "PB", None, None),
    ("Data Magna de Pernambuco", "fixed", 3, 6, None, "PE", None, None),
    ("Dia do Piauí", "fixed", 10, 19, None, "PI", None, None),
    ("Emancipação Política do Paraná", "fixed", 12, 19, None, "PR", None, None),
    ("Terça-feira de Carnaval", "easter", None, None, -47, "RJ", None, None),
    ("São Jorge", "fixed", 4, 23, None, "RJ", None, None),
    ("Mártires de Cunhaú e Uruaçu", "fixed", 10, 3, None, "RN", None, None),
    ("Criação do Estado de Rondônia", "fixed", 1, 4, None, "RO", None, None),
    ("Dia do Evangélico", "fixed", 6, 18, None, "RO", None, None),
    ("Criação do Estado de Roraima", "fixed", 10, 5, None, "RR", None, None),
    ("Revolução Farroupilha", "fixed", 9, 20, None, "RS", None, None),
    ("Data Magna de Santa Catarina", "fixed", 8, 11, None, "SC", None, None),
    ("Autonomia Política de Sergipe", "fixed", 7, 8, None, "SE", None, None),
    ("Revolução Constitucionalista", "fixed", 7, 9, None, "SP", None, None),
    ("Autonomia do Tocantins", "fixed", 3, 18, None, "TO", None, None),
    ("Nossa Senhora da Natividade", "fixed", 9, 8, None, "TO", None, None),
    ("Criação do Estado do Tocantins", "fixed", 10, 5, None, "TO", None, None),
]
