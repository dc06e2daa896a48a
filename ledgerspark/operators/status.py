"""Classification rules ST1-ST5 as ``when`` chains (Column -> Column).

Each rule is the document- or row-level decision of one report variant. The
rules differ on purpose (see the report docstrings); do not merge them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerspark.functions.keys import canonical_type

# Movement types, statuses and the labels of the presence rules.
INCLUSAO = "INCLUSAO"
EXCLUSAO = "EXCLUSAO"
NEGATIVADO = "NEGATIVADO"
BAIXADO = "BAIXADO"
ERRO = "ERRO"
INCLUSAO_LABEL = "INCLUSÃO"
EXCLUSAO_LABEL = "EXCLUSAO"
ERRO_LABEL = "ERRO"
STATUSES = (NEGATIVADO, BAIXADO, ERRO)


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def status_by_type(in_registry: Column, tipo: Column) -> Column:
    """ST1 (document level): the canonical movement type decides, registry presence refines.

    INCLUSAO -> NEGATIVADO if in the registry else ERRO; EXCLUSAO -> ERRO if in
    the registry else BAIXADO; anything else (including null, a status-file
    name or ``-``) -> ERRO.
    """
    t = canonical_type(tipo)
    sgp = _true(in_registry)
    return (
        F.when(t == INCLUSAO, F.when(sgp, NEGATIVADO).otherwise(ERRO))
        .when(t == EXCLUSAO, F.when(sgp, ERRO).otherwise(BAIXADO))
        .otherwise(F.lit(ERRO))
    )


def movement_status(tipo: Column, in_registry: Column) -> Column:
    """ST2 (movement row level): INCLUSAO is always NEGATIVADO; EXCLUSAO as ST1."""
    t = canonical_type(tipo)
    return (
        F.when(t == INCLUSAO, F.lit(NEGATIVADO))
        .when(t == EXCLUSAO, F.when(_true(in_registry), ERRO).otherwise(BAIXADO))
        .otherwise(F.lit(ERRO))
    )


def status_by_presence(in_cnm: Column, in_soa: Column, in_sgp: Column) -> tuple[Column, Column]:
    """ST3: presence only. Returns ``(tipo, status)``."""
    cnm, soa, sgp = _true(in_cnm), _true(in_soa), _true(in_sgp)
    negativado = sgp & (cnm | soa)
    baixado = cnm & ~sgp
    tipo = F.when(negativado, INCLUSAO_LABEL).when(baixado, EXCLUSAO_LABEL).otherwise(ERRO_LABEL)
    status = F.when(negativado, NEGATIVADO).when(baixado, BAIXADO).otherwise(ERRO)
    return tipo, status


def status_cnm_registry(in_cnm: Column, raw_tipo: Column, in_sgp: Column) -> Column:
    """ST4: raw, case-sensitive movement type plus presence in both ledgers."""
    cnm, sgp = _true(in_cnm), _true(in_sgp)
    return (
        F.when(cnm & _true(raw_tipo == INCLUSAO) & sgp, NEGATIVADO)
        .when(cnm & _true(raw_tipo == EXCLUSAO) & ~sgp, BAIXADO)
        .otherwise(F.lit(ERRO))
    )


def status_exports_registry(in_soa: Column, in_sgp: Column) -> tuple[Column, Column]:
    """ST5: in the status exports and in the registry. Returns ``(tipo, status)``."""
    both = _true(in_soa) & _true(in_sgp)
    return (
        F.when(both, INCLUSAO_LABEL).otherwise(ERRO_LABEL),
        F.when(both, NEGATIVADO).otherwise(ERRO),
    )
