"""Seed dictionaries, the area-code lookup and the parameter table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.schemas import TABLES

# Codes and labels the warehouse is seeded with.
FILE_TYPES = [(1, "DPA", "Segurado DPA"), (2, "TRC", "Terceiro TRC"), (0, "N/D", "Não Identificado/Outros")]

QUEUE_STATUSES = [
    (1, "PENDENTE", "Aguardando processamento", 0),
    (2, "ENVIADO", "Sucesso - Retorno 201", 0),
    (3, "ERRO", "Falha na comunicação", 1),
    (4, "CONFLITO", "Erro 409 - Duplicidade", 1),
]

PARTY_TYPES = [(1, "Segurado"), (2, "Terceiro"), (3, "Corretor"), (4, "Analista Seguradora")]

CONTACT_TYPES = [(1, "Telefone Fixo"), (2, "Telefone Celular"), (3, "E-mail")]

# the address that notifications go to is set where the engine runs
PARAMETERS = [("WEBHOOK_POWER_AUTOMATE", "COLE_SUA_URL_AQUI", None), ("ID_SOLICITANTE", None, 80), ("ID_SERVICO", None, 2), ("ID_NATUREZA", None, 3)]

# Telephone area codes with their state and region.
AREA_CODES = [
    (11, "SP", "São Paulo", "Sudeste"),
    (12, "SP", "São Paulo", "Sudeste"),
    (13, "SP", "São Paulo", "Sudeste"),
    (14, "SP", "São Paulo", "Sudeste"),
    (15, "SP", "São Paulo", "Sudeste"),
    (16, "SP", "São Paulo", "Sudeste"),
    (17, "SP", "São Paulo", "Sudeste"),
    (18, "SP", "São Paulo", "Sudeste"),
    (19, "SP", "São Paulo", "Sudeste"),
    (21, "RJ", "Rio de Janeiro", "Sudeste"),
    (22, "RJ", "Rio de Janeiro", "Sudeste"),
    (24, "RJ", "Rio de Janeiro", "Sudeste"),
    (27, "ES", "Espírito Santo", "Sudeste"),
    (28, "ES", "Espírito Santo", "Sudeste"),
    (31, "MG", "Minas Gerais", "Sudeste"),
    (32, "MG", "Minas Gerais", "Sudeste"),
    (33, "MG", "Minas Gerais", "Sudeste"),
    (34, "MG", "Minas Gerais", "Sudeste"),
    (35, "MG", "Minas Gerais", "Sudeste"),
    (37, "MG", "Minas Gerais", "Sudeste"),
    (38, "MG", "Minas Gerais", "Sudeste"),
    (41, "PR", "Paraná", "Sul"),
    (42, "PR", "Paraná", "Sul"),
    (43, "PR", "Paraná", "Sul"),
    (44, "PR", "Paraná", "Sul"),
    (45, "PR", "Paraná", "Sul"),
    (46, "PR", "Paraná", "Sul"),
    (47, "SC", "Santa Catarina", "Sul"),
    (48, "SC", "Santa Catarina", "Sul"),
    (49, "SC", "Santa Catarina", "Sul"),
    (51, "RS", "Rio Grande do Sul", "Sul"),
    (53, "RS", "Rio Grande do Sul", "Sul"),
    (54, "RS", "Rio Grande do Sul", "Sul"),
    (55, "RS", "Rio Grande do Sul", "Sul"),
    (61, "DF", "Distrito Federal", "Centro-Oeste"),
    (62, "GO", "Goiás", "Centro-Oeste"),
    (63, "TO", "Tocantins", "Norte"),
    (64, "GO", "Goiás", "Centro-Oeste"),
    (65, "MT", "Mato Grosso", "Centro-Oeste"),
    (66, "MT", "Mato Grosso", "Centro-Oeste"),
    (67, "MS", "Mato Grosso do Sul", "Centro-Oeste"),
    (68, "AC", "Acre", "Norte"),
    (69, "RO", "Rondônia", "Norte"),
    (71, "BA", "Bahia", "Nordeste"),
    (73, "BA", "Bahia", "Nordeste"),
    (74, "BA", "Bahia", "Nordeste"),
    (75, "BA", "Bahia", "Nordeste"),
    (77, "BA", "Bahia", "Nordeste"),
    (79, "SE", "Sergipe", "Nordeste"),
    (81, "PE", "Pernambuco", "Nordeste"),
    (82, "AL", "Alagoas", "Nordeste"),
    (83, "PB", "Paraíba", "Nordeste"),
    (84, "RN", "Rio Grande do Norte", "Nordeste"),
    (85, "CE", "Ceará", "Nordeste"),
    (86, "PI", "Piauí", "Nordeste"),
    (87, "PE", "Pernambuco", "Nordeste"),
    (88, "CE", "Ceará", "Nordeste"),
    (89, "PI", "Piauí", "Nordeste"),
    (91, "PA", "Pará", "Norte"),
    (92, "AM", "Amazonas", "Norte"),
    (93, "PA", "Pará", "Norte"),
    (94, "PA", "Pará", "Norte"),
    (95, "RR", "Roraima", "Norte"),
    (96, "AP", "Amapá", "Norte"),
    (97, "AM", "Amazonas", "Norte"),
    (98, "MA", "Maranhão", "Nordeste"),
    (99, "MA", "Maranhão", "Nordeste"),
]


def dictionaries(spark: SparkSession, *names: str) -> dict[str, DataFrame]:
    """The seed tables (all, or the named ones), ready to be written once as parquet."""
    seeds = {
        "file_type": [(*row, 1) for row in FILE_TYPES],
        "queue_status": [(*row, 1) for row in QUEUE_STATUSES],
        "party_type": [(*row, 1) for row in PARTY_TYPES],
        "contact_type": [(*row, 1) for row in CONTACT_TYPES],
        "area_code": [(*row, 1) for row in AREA_CODES],
        "parameter": PARAMETERS,
    }
    return {name: _inline(spark, name, rows) for name, rows in seeds.items() if not names or name in names}


def _inline(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    """Rows inside the plan: Spark knows that they are few, and broadcasts them by size."""
    fields = TABLES[name].fields
    listed = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows])
    return spark.range(1).select(F.inline(listed))


def load_area_map(areas: DataFrame) -> DataFrame:
    """code -> uf of the active area codes (at most one row per two-digit code)."""
    return areas.filter(F.col("active") == 1).select("code", "uf")


def typed_params(params: DataFrame) -> DataFrame:
    """One row per key with its number, or its text where there is no number."""
    number = F.col("number").cast("long")
    return params.select(
        "key", number.alias("number"), F.when(number.isNull(), F.col("text")).alias("text")
    )


def param_number(params: DataFrame, keys: dict[str, str]) -> DataFrame:
    """One-row DataFrame with a long column per requested key (name -> key)."""
    return params.filter(F.col("key").isin(*keys.values())).agg(
        *[F.max(F.when(F.col("key") == key, F.col("number"))).cast("long").alias(name) for name, key in keys.items()]
    )
