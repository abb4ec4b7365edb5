"""Small literal dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Brazilian state code -> state name (27 entries, display only).
STATE_NAMES = {
    "AC": "Acre", "AL": "Alagoas", "AM": "Amazonas", "AP": "Amapá", "BA": "Bahia",
    "CE": "Ceará", "DF": "Distrito Federal", "ES": "Espírito Santo", "GO": "Goiás",
    "MA": "Maranhão", "MG": "Minas Gerais", "MS": "Mato Grosso do Sul",
    "MT": "Mato Grosso", "PA": "Pará", "PB": "Paraíba", "PE": "Pernambuco",
    "PI": "Piauí", "PR": "Paraná", "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte",
    "RO": "Rondônia", "RR": "Roraima", "RS": "Rio Grande do Sul", "SC": "Santa Catarina",
    "SE": "Sergipe", "SP": "São Paulo", "TO": "Tocantins",
}


def state_names(spark: SparkSession) -> DataFrame:
    """27-row dimension (estado, estado_nome); its size is fixed, so it is safe
    to broadcast."""
    return spark.createDataFrame(sorted(STATE_NAMES.items()), "estado string, estado_nome string")
