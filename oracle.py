"""Independent SQL for every registered query, over the same tables.

Written as plain ANSI-style SQL with textbook windows and joins; but for the invented names of leagues
and sides nothing is shared with the Spark code, so an error in one is not repeated in the other.
"""

from __future__ import annotations

from lotforge.plans.generate import CHAMPIONSHIPS, TEAMS

RAW = """
raw_apostadores AS (
  SELECT CAST(c_custkey AS VARCHAR) AS apostador_id,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) AS criado_em,
         CASE WHEN c_acctbal < 0 THEN '  ' ELSE n_name END AS estado,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) || ' 00:00:00' AS atualizado_em,
         '1995-01-01/apostadores_1995-01-01.csv' AS arquivo_origem,
         c_custkey + 2 AS linha_origem,
         TIMESTAMP '2024-02-01 00:00:00' AS carregado_em,
         DATE '1995-01-01' AS lote_data
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
raw_eventos AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS evento_id,
         CASE WHEN o_totalprice < 20000 THEN 'xadrez'
              WHEN o_orderpriority = '1-URGENT' THEN 'futebol'
              WHEN o_orderpriority = '2-HIGH' THEN 'basquete'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'tenis'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'volei'
              WHEN o_orderpriority = '5-LOW' THEN 'mma'
              ELSE o_orderpriority END AS esporte,
         'Liga ' || o_orderstatus AS campeonato,
         'Time ' || CAST(o_custkey AS VARCHAR) AS time_casa,
         'Time ' || CAST(o_custkey + 1 AS VARCHAR) AS time_visitante,
         CAST(CAST(o_orderdate AS DATE) + 1400 AS VARCHAR) AS data_evento,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS atualizado_em,
         '1995-01-01/eventos_1995-01-01.csv' AS arquivo_origem,
         o_orderkey + 2 AS linha_origem,
         TIMESTAMP '2024-02-01 00:00:00' AS carregado_em,
         DATE '1995-01-01' AS lote_data
  FROM orders
),
linhas AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS aposta,
         CAST((l_quantity + 10) / 10 AS DECIMAL(8,2)) AS cotacao,
         CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'ganha'
              WHEN l_linestatus = 'F' THEN 'perdida'
              WHEN l_returnflag = 'A' THEN 'cancelada'
              ELSE 'pendente' END AS estado_aposta
  FROM lineitem
),
raw_apostas AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS aposta_id,
         CASE WHEN l_tax = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS apostador_id,
         CAST(l_orderkey AS VARCHAR) AS evento_id,
         CASE WHEN l_quantity = 48 THEN strftime(l_shipdate, '%d/%m/%Y')
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS data_aposta,
         CAST(CASE WHEN l_discount = 0 THEN -aposta
                   WHEN l_discount = 0.1 THEN CAST(0 AS DECIMAL(12,2))
                   ELSE aposta END AS VARCHAR) AS valor_apostado,
         CASE WHEN l_quantity = 50 THEN 'n/d' ELSE CAST(cotacao AS VARCHAR) END AS odd,
         CASE WHEN l_quantity = 49 THEN 'anulada'
              WHEN l_quantity = 47 THEN ' ' || estado_aposta || ' '
              ELSE estado_aposta END AS status,
         CAST(CASE WHEN estado_aposta = 'ganha' THEN CAST(aposta * cotacao AS DECIMAL(12,2))
                   WHEN l_tax = 0.08 THEN CAST(1 AS DECIMAL(12,2))
                   ELSE CAST(0 AS DECIMAL(12,2)) END AS VARCHAR) AS premio_pago,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS atualizado_em,
         strftime(l_shipdate, '%Y') || '-01-01/apostas_' || CAST(l_partkey AS VARCHAR) || '-'
           || CAST(l_suppkey AS VARCHAR) || '.csv' AS arquivo_origem,
         l_orderkey * 10 + l_linenumber AS linha_origem,
         TIMESTAMP '2024-02-01 00:00:00' AS carregado_em,
         CAST(strftime(l_shipdate, '%Y') || '-01-01' AS DATE) AS lote_data
  FROM linhas
),
raw_transacoes AS (
  SELECT CAST(event_id AS VARCHAR) AS transacao_id,
         CAST(user_id AS VARCHAR) AS apostador_id,
         strftime(ts, '%Y-%m-%d') AS data_transacao,
         CASE event_type WHEN 'purchase' THEN 'deposito' WHEN 'signup' THEN 'saque'
              ELSE event_type END AS tipo,
         CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS valor,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS atualizado_em,
         strftime(ts, '%Y-%m-%d') || '/transacoes_' || strftime(ts, '%Y-%m-%d') || '.csv' AS arquivo_origem,
         event_id + 2 AS linha_origem,
         TIMESTAMP '2024-02-01 00:00:00' AS carregado_em,
         CAST(ts AS DATE) AS lote_data
  FROM events
)"""


def _date(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') "
        f"THEN TRY_CAST({column} AS DATE) END"
    )


_COLUMNS = {
    "apostadores": "apostador_id criado_em estado atualizado_em".split(),
    "eventos": "evento_id esporte campeonato time_casa time_visitante data_evento atualizado_em".split(),
    "apostas": (
        "aposta_id apostador_id evento_id data_aposta valor_apostado odd status premio_pago"
        " atualizado_em"
    ).split(),
    "transacoes": "transacao_id apostador_id data_transacao tipo valor atualizado_em".split(),
}


def _record(entity: str) -> str:
    pairs = ", ".join(f"'{c}', {c}" for c in _COLUMNS[entity])
    return f"CAST(json_merge_patch('{{}}', json_object({pairs})) AS VARCHAR) AS registro_original"


def _typed(suffix: str = "") -> str:
    return f"""
tip_apostadores{suffix} AS (
  SELECT nullif(trim(apostador_id), '') AS apostador_id, {_date("criado_em")} AS criado_em,
         nullif(trim(estado), '') AS estado, TRY_CAST(atualizado_em AS TIMESTAMP) AS atualizado_em,
         arquivo_origem, linha_origem, lote_data, {_record("apostadores")}
  FROM raw_apostadores{suffix}
),
tip_eventos{suffix} AS (
  SELECT nullif(trim(evento_id), '') AS evento_id, nullif(trim(esporte), '') AS esporte,
         nullif(trim(campeonato), '') AS campeonato, nullif(trim(time_casa), '') AS time_casa,
         nullif(trim(time_visitante), '') AS time_visitante, {_date("data_evento")} AS data_evento,
         TRY_CAST(atualizado_em AS TIMESTAMP) AS atualizado_em,
         arquivo_origem, linha_origem, lote_data, {_record("eventos")}
  FROM raw_eventos{suffix}
),
tip_apostas{suffix} AS (
  SELECT nullif(trim(aposta_id), '') AS aposta_id, nullif(trim(apostador_id), '') AS apostador_id,
         nullif(trim(evento_id), '') AS evento_id, {_date("data_aposta")} AS data_aposta,
         TRY_CAST(valor_apostado AS DECIMAL(12,2)) AS valor_apostado,
         TRY_CAST(odd AS DECIMAL(8,2)) AS odd, nullif(trim(status), '') AS status,
         TRY_CAST(premio_pago AS DECIMAL(12,2)) AS premio_pago,
         TRY_CAST(atualizado_em AS TIMESTAMP) AS atualizado_em,
         arquivo_origem, linha_origem, lote_data, {_record("apostas")}
  FROM raw_apostas{suffix}
),
tip_transacoes{suffix} AS (
  SELECT nullif(trim(transacao_id), '') AS transacao_id,
         nullif(trim(apostador_id), '') AS apostador_id, {_date("data_transacao")} AS data_transacao,
         nullif(trim(tipo), '') AS tipo, TRY_CAST(valor AS DECIMAL(12,2)) AS valor,
         TRY_CAST(atualizado_em AS TIMESTAMP) AS atualizado_em,
         arquivo_origem, linha_origem, lote_data, {_record("transacoes")}
  FROM raw_transacoes{suffix}
)"""


def _order(*columns: str) -> str:
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in columns)
    return f"{newest}, arquivo_origem ASC NULLS LAST, linha_origem ASC NULLS LAST"


_ORDER_APOSTADORES = _order("atualizado_em", "criado_em", "estado")
_ORDER_EVENTOS = _order("atualizado_em", "data_evento", "esporte")
_ORDER_APOSTAS = _order(
    "atualizado_em", "valor_apostado", "status", "premio_pago", "odd", "data_aposta"
)
_ORDER_TRANSACOES = _order("atualizado_em", "valor", "tipo")


def _missing(entity: str) -> str:
    return " OR ".join(f"{c} IS NULL" for c in _COLUMNS[entity])


def _reasons(*pairs: tuple[str, str]) -> str:
    items = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in pairs)
    return f"list_filter([{items}], lambda m: m IS NOT NULL) AS motivos"


def _validated(suffix: str = "") -> str:
    s = suffix
    return f"""
val_apostadores{s} AS (
  SELECT *, {_reasons(("duplicata", "versao > 1"), ("nulo_obrigatorio", _missing("apostadores")))}
  FROM (SELECT *, row_number() OVER (PARTITION BY apostador_id ORDER BY {_ORDER_APOSTADORES}) AS versao
        FROM tip_apostadores{s})
),
cln_apostadores{s} AS (SELECT * FROM val_apostadores{s} WHERE len(motivos) = 0),
val_eventos{s} AS (
  SELECT *, {_reasons(("duplicata", "versao > 1"), ("nulo_obrigatorio", _missing("eventos")),
                      ("status_invalido",
                       "esporte NOT IN ('futebol','basquete','tenis','volei','mma')"))}
  FROM (SELECT *, row_number() OVER (PARTITION BY evento_id ORDER BY {_ORDER_EVENTOS}) AS versao
        FROM tip_eventos{s})
),
cln_eventos{s} AS (SELECT * FROM val_eventos{s} WHERE len(motivos) = 0),
val_apostas{s} AS (
  SELECT *, {_reasons(
      ("duplicata", "versao > 1"), ("nulo_obrigatorio", _missing("apostas")),
      ("valor_nao_positivo", "valor_apostado <= 0"),
      ("data_posterior_ao_evento", "data_aposta > data_evento"),
      ("apostador_inexistente", "apostador_id IS NOT NULL AND NOT apostador_existe"),
      ("evento_inexistente", "evento_id IS NOT NULL AND NOT evento_existe"),
      ("premio_inconsistente", "status IN ('perdida','pendente','cancelada') AND premio_pago <> 0"),
      ("status_invalido", "status NOT IN ('ganha','perdida','pendente','cancelada')"))}
  FROM (SELECT t.*, e.esporte, e.data_evento, e.evento_id IS NOT NULL AS evento_existe,
               a.apostador_id IS NOT NULL AS apostador_existe,
               row_number() OVER (PARTITION BY t.aposta_id ORDER BY
                 t.atualizado_em DESC NULLS LAST, t.valor_apostado DESC NULLS LAST,
                 t.status DESC NULLS LAST, t.premio_pago DESC NULLS LAST, t.odd DESC NULLS LAST,
                 t.data_aposta DESC NULLS LAST, t.arquivo_origem ASC NULLS LAST,
                 t.linha_origem ASC NULLS LAST) AS versao
        FROM tip_apostas{s} t
        LEFT JOIN cln_eventos{s} e ON t.evento_id = e.evento_id
        LEFT JOIN cln_apostadores{s} a ON t.apostador_id = a.apostador_id)
),
cln_apostas{s} AS (SELECT * FROM val_apostas{s} WHERE len(motivos) = 0),
val_transacoes{s} AS (
  SELECT *, {_reasons(
      ("duplicata", "versao > 1"), ("nulo_obrigatorio", _missing("transacoes")),
      ("valor_nao_positivo", "valor <= 0"),
      ("apostador_inexistente", "apostador_id IS NOT NULL AND NOT apostador_existe"),
      ("status_invalido", "tipo NOT IN ('deposito','saque')"))}
  FROM (SELECT t.*, a.apostador_id IS NOT NULL AS apostador_existe,
               row_number() OVER (PARTITION BY t.transacao_id ORDER BY
                 t.atualizado_em DESC NULLS LAST, t.valor DESC NULLS LAST, t.tipo DESC NULLS LAST,
                 t.arquivo_origem ASC NULLS LAST, t.linha_origem ASC NULLS LAST) AS versao
        FROM tip_transacoes{s} t
        LEFT JOIN cln_apostadores{s} a ON t.apostador_id = a.apostador_id)
),
cln_transacoes{s} AS (SELECT * FROM val_transacoes{s} WHERE len(motivos) = 0)"""


_FACT_COLUMNS = """aposta_id, apostador_id, evento_id, data_aposta, esporte, valor_apostado, odd,
         status, premio_pago,
         CAST(CASE WHEN status IN ('ganha','perdida') THEN valor_apostado - premio_pago END
              AS DECIMAL(13,2)) AS resultado_casa, atualizado_em, lote_data"""

MARTS = f"""
fct_apostas AS (SELECT {_FACT_COLUMNS} FROM cln_apostas),
fct_transacoes AS (
  SELECT transacao_id, apostador_id, data_transacao, tipo, valor, atualizado_em, lote_data
  FROM cln_transacoes
),
dim_eventos AS (
  SELECT evento_id, esporte, campeonato, time_casa, time_visitante, data_evento FROM cln_eventos
)"""


def ggr_of(relation: str) -> str:
    return f"""
  SELECT data_aposta, esporte,
         CAST(coalesce(sum(valor_apostado) FILTER (status IN ('ganha','perdida')), 0) AS DECIMAL(22,2)) AS total_apostado,
         CAST(coalesce(sum(premio_pago) FILTER (status IN ('ganha','perdida')), 0) AS DECIMAL(22,2)) AS premios_pagos,
         CAST(coalesce(sum(valor_apostado - premio_pago) FILTER (status IN ('ganha','perdida')), 0) AS DECIMAL(22,2)) AS ggr,
         CAST(coalesce(sum(valor_apostado) FILTER (status = 'pendente'), 0) AS DECIMAL(22,2)) AS exposicao_pendente,
         count(*) FILTER (status IN ('ganha','perdida')) AS qtd_apostas_resolvidas
  FROM {relation} GROUP BY data_aposta, esporte"""


_MEAN = """CAST((2 * CAST(sum(valor_apostado) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE)
           / 1000000"""

AGGREGATES = f"""
agg_ggr AS ({ggr_of("fct_apostas")}),
agg_engajamento AS (
  SELECT data_aposta, CAST(sum(valor_apostado) AS DECIMAL(22,2)) AS volume_apostado,
         {_MEAN} AS ticket_medio,
         count(DISTINCT apostador_id) AS apostadores_ativos, count(*) AS qtd_apostas
  FROM fct_apostas GROUP BY data_aposta
),
agg_financeiro AS (
  SELECT data_transacao,
         CAST(coalesce(sum(valor) FILTER (tipo = 'deposito'), 0) AS DECIMAL(22,2)) AS total_depositado,
         CAST(coalesce(sum(valor) FILTER (tipo = 'saque'), 0) AS DECIMAL(22,2)) AS total_sacado,
         CAST(coalesce(sum(CASE tipo WHEN 'deposito' THEN valor WHEN 'saque' THEN -valor END), 0) AS DECIMAL(22,2)) AS liquido,
         count(*) FILTER (tipo = 'deposito') AS qtd_depositos,
         count(*) FILTER (tipo = 'saque') AS qtd_saques
  FROM fct_transacoes GROUP BY data_transacao
)"""


def _quarantine(entity: str, key: str) -> str:
    return f"""SELECT '{entity}' AS entidade, {key} AS chave_natural, registro_original,
         array_to_string(motivos, ',') AS motivos, arquivo_origem, linha_origem, lote_data,
         TIMESTAMP '2024-02-02 00:00:00' AS rejeitado_em
  FROM val_{entity} WHERE len(motivos) > 0"""


_KEYS = {
    "apostadores": "apostador_id",
    "eventos": "evento_id",
    "apostas": "aposta_id",
    "transacoes": "transacao_id",
}

QUARANTINE = "\nquarentena AS (\n  " + "\n  UNION ALL ".join(
    _quarantine(e, k) for e, k in _KEYS.items()
) + ")"

_JUDGED = " UNION ALL ".join(
    f"SELECT '{entity}' AS entidade, lote_data, motivos FROM val_{entity}" for entity in _COLUMNS
)
QUALITY = f"""
julgadas AS ({_JUDGED}),
lotes AS (
  SELECT lote_data, entidade, count(*) AS n, count(*) FILTER (len(motivos) > 0) AS ruins
  FROM julgadas GROUP BY ALL
),
agg_qualidade AS (
  SELECT lote_data, entidade, coalesce(m, 'sem_rejeicao') AS motivo, n AS qtd_recebidos,
         n - ruins AS qtd_aceitos, count(m) AS qtd_rejeitados, ruins AS qtd_rejeitados_distintos,
         CAST(((2 * ruins * 10000 + n) // (2 * n)) / 10000.0 AS DECIMAL(5,4)) AS taxa_rejeicao
  FROM lotes
  LEFT JOIN (SELECT lote_data, entidade, unnest(motivos) AS m FROM julgadas) USING (lote_data, entidade)
  GROUP BY lote_data, entidade, m, n, ruins
)"""

BASE = ",".join([RAW, _typed(), _validated()])
FULL = ",".join([BASE, MARTS, AGGREGATES, QUARANTINE, QUALITY])


def q(select: str, ctes: str = FULL) -> str:
    return f"WITH {ctes}\n{select}"


def lot_chain(suffix: str, raw_ctes: str) -> str:
    """A second validation chain over raw relations ending in `suffix`."""
    return ",".join([raw_ctes, _typed(suffix), _validated(suffix)])


# --- query texts ---------------------------------------------------------------------------

_EARLIER = lot_chain(
    "_a",
    """
raw_apostadores_a AS (SELECT * FROM raw_apostadores),
raw_eventos_a AS (SELECT * FROM raw_eventos),
raw_apostas_a AS (SELECT * FROM raw_apostas WHERE lote_data < DATE '2001-01-01'),
raw_transacoes_a AS (SELECT * FROM raw_transacoes)""",
)
_REGENERATED = lot_chain(
    "_r",
    """
raw_apostadores_r AS (SELECT * FROM raw_apostadores),
raw_eventos_r AS (SELECT * FROM raw_eventos),
raw_apostas_r AS (SELECT * FROM raw_apostas
                  WHERE NOT (lote_data = DATE '1998-01-01' AND trim(status) = 'pendente')),
raw_transacoes_r AS (SELECT * FROM raw_transacoes)""",
)
_REMADE = f"""
refeito AS (SELECT {_FACT_COLUMNS} FROM cln_apostas_r WHERE lote_data = DATE '1998-01-01')"""
_MERGED = f"""
antes AS (SELECT {_FACT_COLUMNS} FROM cln_apostas_a),
lote AS (SELECT * FROM fct_apostas WHERE lote_data = DATE '2001-01-01'),
fundido AS (
  SELECT * FROM antes WHERE lote_data <> DATE '2001-01-01'
    AND aposta_id NOT IN (SELECT aposta_id FROM lote)
  UNION ALL SELECT * FROM lote
)"""
_MERGE_CTES = ",".join([BASE, MARTS, _EARLIER, _MERGED])

#: What must not reach the fact, by the reason it is known under.
_FACT_FAULTS = {
    "nulo_obrigatorio": "concat_ws('', aposta_id, '') = '' OR apostador_id IS NULL OR evento_id IS NULL"
    " OR data_aposta IS NULL OR status IS NULL",
    "valor_nao_positivo": "NOT valor_apostado > 0",
    "premio_negativo": "premio_pago < 0",
    "premio_inconsistente": "premio_pago <> 0 AND status IN ('perdida','pendente','cancelada')",
    "status_invalido": "status NOT IN ('ganha','perdida','pendente','cancelada')",
    "data_posterior_ao_evento": "data_aposta > data_evento",
}
#: Relations that a probe looks at, and their columns that add up.
_PROBED = {
    "raw_apostas": ("raw_apostas", ()),
    "fct_apostas": ("fct_apostas", ("valor_apostado", "odd", "premio_pago", "resultado_casa")),
    "agg_ggr_diario_esporte": (
        "agg_ggr",
        ("total_apostado", "premios_pagos", "ggr", "exposicao_pendente", "qtd_apostas_resolvidas"),
    ),
    "agg_engajamento_diario": ("agg_engajamento", ("volume_apostado", "apostadores_ativos", "qtd_apostas")),
    "agg_financeiro_diario": (
        "agg_financeiro",
        ("total_depositado", "total_sacado", "liquido", "qtd_depositos", "qtd_saques"),
    ),
    "agg_qualidade_lote": (
        "agg_qualidade",
        ("qtd_recebidos", "qtd_aceitos", "qtd_rejeitados", "qtd_rejeitados_distintos"),
    ),
}


def _probes() -> str:
    parts = []
    for table, (relation, columns) in _PROBED.items():
        parts.append(f"SELECT '{table}' AS tabela, 'linhas' AS medida, count(*)::DECIMAL(22,2) AS valor FROM {relation}")
        parts += [
            f"SELECT '{table}', '{c}', coalesce(sum({c}), 0)::DECIMAL(22,2) FROM {relation}" for c in columns
        ]
    return " UNION ALL ".join(parts)


_ENTITY_LIST = ("apostadores", "eventos", "apostas", "transacoes")
_CARRIED = {"apostas": ", esporte, data_evento"}


def _rule_sql(*parts: tuple[str, str, str]) -> str:
    """`parts` are (entity, relation, condition)."""
    return "\nUNION ALL\n".join(
        f"SELECT '{e}' AS entidade, {_KEYS[e]} AS chave_natural, arquivo_origem, linha_origem"
        f" FROM {relation} WHERE {condition}"
        for e, relation, condition in parts
    )


def _has(entity: str, reason: str) -> tuple[str, str, str]:
    return entity, f"val_{entity}", f"list_contains(motivos, '{reason}')"


def core_oracle() -> dict[str, str]:
    texts: dict[str, str] = {}
    clean = {
        "apostadores": "apostador_id, criado_em, estado, atualizado_em, lote_data",
        "eventos": (
            "evento_id, esporte, campeonato, time_casa, time_visitante, data_evento,"
            " atualizado_em, lote_data"
        ),
        "apostas": (
            "aposta_id, apostador_id, evento_id, data_aposta, valor_apostado, odd, status,"
            " premio_pago, esporte, data_evento, atualizado_em, lote_data"
        ),
        "transacoes": (
            "transacao_id, apostador_id, data_transacao, tipo, valor, atualizado_em, lote_data"
        ),
    }
    for e in _ENTITY_LIST:
        columns = ", ".join(_COLUMNS[e]) + _CARRIED.get(e, "")
        texts[f"stg_{e}"] = q(f"SELECT {clean[e]} FROM cln_{e}")
        texts[f"quarantine_{e}"] = q(f"SELECT * FROM quarentena WHERE entidade = '{e}'")
        texts[f"validate_{e}"] = q(
            f"SELECT {columns}, arquivo_origem, linha_origem, lote_data,"
            f" array_to_string(motivos, ',') AS motivos FROM val_{e}"
        )
        texts[f"window_versao_{e}"] = q(
            f"SELECT {_KEYS[e]}, arquivo_origem, linha_origem, versao > 1 AS superada FROM val_{e}"
        )
    quality_of = "FROM agg_qualidade WHERE lote_data = DATE '1998-01-01'"
    texts |= {
        "agg_ggr": q("SELECT * FROM agg_ggr"),
        "agg_engajamento": q("SELECT * FROM agg_engajamento"),
        "agg_financeiro": q("SELECT * FROM agg_financeiro"),
        "agg_qualidade_lote": q("SELECT * FROM agg_qualidade"),
        "dim_apostadores": q(
            "SELECT apostador_id, criado_em, estado,"
            " CAST(date_diff('day', criado_em, (SELECT max(data_aposta) FROM cln_apostas))"
            " AS INTEGER) AS antiguidade_dias FROM cln_apostadores"
        ),
        "dim_eventos": q("SELECT * FROM dim_eventos"),
        "fct_apostas": q("SELECT * FROM fct_apostas"),
        "fct_transacoes": q("SELECT * FROM fct_transacoes"),
        "proj_blank_to_null": q(
            "SELECT arquivo_origem, linha_origem, aposta_id, apostador_id, evento_id, status"
            " FROM tip_apostas"
        ),
        "proj_try_date": q("SELECT arquivo_origem, linha_origem, data_aposta FROM tip_apostas"),
        "proj_try_decimal": q(
            "SELECT arquivo_origem, linha_origem, valor_apostado, odd, premio_pago"
            " FROM tip_apostas"
        ),
        "proj_try_timestamp": q(
            "SELECT arquivo_origem, linha_origem, atualizado_em FROM tip_apostas"
        ),
        "proj_record_json": q(
            "SELECT arquivo_origem, linha_origem, registro_original FROM tip_apostas"
        ),
        "quarantine_all": q("SELECT * FROM quarentena"),
        "rule_duplicata": q(
            _rule_sql(*((e, f"val_{e}", "versao > 1") for e in _ENTITY_LIST))
        ),
        "rule_nulo": q(_rule_sql(*(_has(e, "nulo_obrigatorio") for e in _ENTITY_LIST))),
        "rule_valor": q(
            _rule_sql(
                ("apostas", "tip_apostas", "valor_apostado <= 0"),
                ("transacoes", "tip_transacoes", "valor <= 0"),
            )
        ),
        "rule_data": q(_rule_sql(("apostas", "val_apostas", "data_aposta > data_evento"))),
        "rule_fk_apostador": q(
            _rule_sql(
                *(
                    (e, f"tip_{e}", "apostador_id NOT IN (SELECT apostador_id FROM cln_apostadores)")
                    for e in ("apostas", "transacoes")
                )
            )
        ),
        "rule_fk_evento": q(
            _rule_sql(
                ("apostas", "tip_apostas", "evento_id NOT IN (SELECT evento_id FROM cln_eventos)")
            )
        ),
        "rule_premio": q(_rule_sql(_has("apostas", "premio_inconsistente"))),
        "rule_status": q(
            _rule_sql(
                ("eventos", "tip_eventos",
                 "esporte NOT IN ('futebol','basquete','tenis','volei','mma')"),
                ("apostas", "tip_apostas",
                 "status NOT IN ('ganha','perdida','pendente','cancelada')"),
                ("transacoes", "tip_transacoes", "tipo NOT IN ('deposito','saque')"),
            )
        ),
        "join_left_evento": q(
            "SELECT t.arquivo_origem, t.linha_origem, t.evento_id, e.esporte, e.data_evento,"
            " e.evento_id IS NOT NULL AS evento_existe"
            " FROM tip_apostas t LEFT JOIN cln_eventos e ON t.evento_id = e.evento_id"
        ),
        "join_left_apostador": q(
            "SELECT t.arquivo_origem, t.linha_origem, t.apostador_id,"
            " a.apostador_id IS NOT NULL AS apostador_existe"
            " FROM tip_apostas t LEFT JOIN cln_apostadores a ON t.apostador_id = a.apostador_id"
        ),
        "explode_motivos": q(
            "SELECT entidade, chave_natural, unnest(string_split(motivos, ',')) AS motivo,"
            " arquivo_origem, linha_origem, lote_data FROM quarentena"
        ),
        "agg_cond_sum": q(
            "SELECT lote_data,"
            " CAST(coalesce(sum(CASE WHEN status IN ('ganha','perdida') THEN valor_apostado END), 0)"
            " AS DECIMAL(22,2)) AS total_apostado,"
            " CAST(coalesce(sum(CASE WHEN status = 'pendente' THEN valor_apostado END), 0)"
            " AS DECIMAL(22,2)) AS exposicao FROM tip_apostas GROUP BY lote_data"
        ),
        "agg_cond_count": q(
            "SELECT lote_data, count(CASE WHEN tipo = 'deposito' THEN 1 END) AS qtd_depositos,"
            " count(CASE WHEN tipo = 'saque' THEN 1 END) AS qtd_saques"
            " FROM tip_transacoes GROUP BY lote_data"
        ),
        "agg_count": q(
            "SELECT lote_data, status, count(*) AS qtd FROM tip_apostas GROUP BY lote_data, status"
        ),
        "agg_count_distinct": q(
            "SELECT data_aposta, count(DISTINCT apostador_id) AS apostadores_ativos"
            " FROM tip_apostas GROUP BY data_aposta"
        ),
        "agg_avg": q(
            "SELECT data_aposta, CASE WHEN s >= 0 THEN (2 * s * 10000 + n) // (2 * n)"
            " ELSE -((-2 * s * 10000 + n) // (2 * n)) END / 1000000 AS ticket_medio"
            " FROM (SELECT data_aposta, CAST(sum(valor_apostado) * 100 AS HUGEINT) AS s,"
            " count(valor_apostado) AS n FROM tip_apostas GROUP BY data_aposta)"
        ),
        "fact_merge": q("SELECT * FROM fundido", _MERGE_CTES),
        "late_status": q(
            "SELECT a.data_aposta, a.esporte, a.ggr AS ggr_antes, d.ggr AS ggr_depois,"
            " a.exposicao_pendente AS exposicao_antes, d.exposicao_pendente AS exposicao_depois"
            f" FROM ({ggr_of('antes')}) a JOIN ({ggr_of('fundido')}) d"
            " ON a.data_aposta = d.data_aposta AND a.esporte = d.esporte"
            " WHERE a.ggr <> d.ggr OR a.exposicao_pendente <> d.exposicao_pendente",
            _MERGE_CTES,
        ),
        "fact_orphan_delete": q(
            "SELECT * FROM fct_apostas WHERE lote_data <> DATE '1998-01-01'"
            " AND aposta_id NOT IN (SELECT aposta_id FROM refeito) UNION ALL SELECT * FROM refeito",
            ",".join([BASE, MARTS, _REGENERATED, _REMADE]),
        ),
        "t_unique": q(
            "SELECT aposta_id, count(*) AS linhas FROM tip_apostas WHERE aposta_id IS NOT NULL"
            " GROUP BY aposta_id HAVING count(*) > 1"
        ),
        "t_not_null": q(
            "SELECT aposta_id, arquivo_origem, linha_origem FROM tip_apostas"
            " WHERE apostador_id IS NULL"
        ),
        "t_accepted_values": q(
            "SELECT tipo AS valor, count(*) AS linhas FROM tip_transacoes"
            " WHERE tipo NOT IN ('deposito','saque') GROUP BY tipo"
        ),
        "t_relationships": q(
            "SELECT apostador_id AS chave, count(*) AS linhas FROM tip_apostas"
            " WHERE apostador_id NOT IN (SELECT apostador_id FROM cln_apostadores)"
            " GROUP BY apostador_id"
        ),
        "t_fact_unique": q(
            "SELECT aposta_id, count(*) AS linhas FROM tip_apostas GROUP BY 1 HAVING count(*) > 1"
        ),
        "t_ggr_grain": q(
            "SELECT data_aposta, esporte, count(DISTINCT status) AS linhas FROM fct_apostas"
            " WHERE status IN ('ganha','perdida') GROUP BY 1, 2 HAVING count(DISTINCT status) > 1"
        ),
        "t_ggr_identity": q(
            "SELECT data_aposta, esporte, total_apostado, premios_pagos,"
            " ggr + exposicao_pendente AS ggr FROM agg_ggr WHERE exposicao_pendente <> 0"
        ),
        "t_ggr_status": q(
            "SELECT coalesce(a.data_aposta, e.data_aposta) AS data_aposta,"
            " coalesce(a.esporte, e.esporte) AS esporte, a.total_apostado AS no_agregado,"
            " e.total_apostado AS recalculado FROM"
            f" ({ggr_of('(SELECT * FROM fct_apostas WHERE status <> ' + chr(39) + 'perdida' + chr(39) + ')')}) a"
            " FULL JOIN agg_ggr e ON a.data_aposta = e.data_aposta AND a.esporte = e.esporte"
            " WHERE a.total_apostado IS DISTINCT FROM e.total_apostado"
        ),
        "t_exposure": q(
            "SELECT g.data_aposta, g.esporte, s.v AS no_agregado, exposicao_pendente AS recalculado"
            " FROM agg_ggr g LEFT JOIN (SELECT data_aposta, esporte, CAST(0 AS DECIMAL(22,2)) AS v"
            " FROM fct_apostas WHERE status <> 'pendente' GROUP BY 1, 2) s"
            " ON s.data_aposta = g.data_aposta AND s.esporte = g.esporte"
            " WHERE s.v IS DISTINCT FROM exposicao_pendente"
        ),
        "t_volume": q(
            "SELECT e.data_aposta, CAST(s.v AS DECIMAL(22,2)) AS no_agregado,"
            " e.volume_apostado AS recalculado FROM agg_engajamento e LEFT JOIN"
            " (SELECT data_aposta, sum(valor_apostado) AS v FROM fct_apostas"
            "  WHERE status IN ('ganha','perdida') GROUP BY 1) s ON s.data_aposta = e.data_aposta"
            " WHERE s.v IS DISTINCT FROM e.volume_apostado"
        ),
        "t_active": q(
            "SELECT e.data_aposta, s.v AS no_agregado, e.apostadores_ativos AS recalculado"
            " FROM agg_engajamento e LEFT JOIN"
            " (SELECT data_aposta, count(DISTINCT apostador_id) AS v FROM fct_apostas"
            "  WHERE status IN ('ganha','perdida') GROUP BY 1) s ON s.data_aposta = e.data_aposta"
            " WHERE s.v IS DISTINCT FROM e.apostadores_ativos"
        ),
        "t_ticket": q(
            "SELECT data_aposta, qtd_apostas, CAST(NULL AS DOUBLE) AS ticket_medio"
            " FROM agg_engajamento WHERE qtd_apostas % 2 = 1"
        ),
        "t_net": q(
            "SELECT data_transacao, total_depositado, total_sacado, liquido + 2 * total_sacado AS liquido"
            " FROM agg_financeiro WHERE total_sacado <> 0"
        ),
        "t_no_invalid": q(
            "SELECT aposta_id, unnest(list_filter(["
            + ", ".join(f"CASE WHEN {test} THEN '{kind}' END" for kind, test in _FACT_FAULTS.items())
            + "], lambda v: v IS NOT NULL)) AS violacao"
            " FROM tip_apostas LEFT JOIN (SELECT evento_id, data_evento FROM tip_eventos) USING (evento_id)"
        ),
        "t_quality_grain": q(
            "SELECT lote_data, entidade, motivo, 2 AS linhas FROM agg_qualidade WHERE entidade = 'apostas'"
        ),
        "t_received": q(
            "SELECT lote_data, entidade, max(qtd_recebidos) AS recebidos,"
            " max(qtd_aceitos) AS aceitos, max(qtd_rejeitados) AS rejeitados"
            " FROM agg_qualidade GROUP BY 1, 2"
            " HAVING max(qtd_recebidos) <> max(qtd_aceitos) + max(qtd_rejeitados)"
        ),
        "q_ggr_day": q(
            "SELECT data_aposta, esporte, total_apostado, premios_pagos, ggr, exposicao_pendente"
            " FROM agg_ggr WHERE data_aposta = DATE '1998-07-01' ORDER BY ggr DESC"
        ),
        "q_engagement": q("SELECT * FROM agg_engajamento ORDER BY data_aposta DESC"),
        "q_finance": q("SELECT * FROM agg_financeiro ORDER BY data_transacao DESC"),
        "q_rejects": q(f"SELECT entidade, motivo, qtd_rejeitados, taxa_rejeicao {quality_of}"),
        "q_trace_reason": q(
            "SELECT entidade, chave_natural, motivos, arquivo_origem, linha_origem,"
            " registro_original FROM quarentena WHERE lote_data = DATE '1998-01-01'"
            " AND list_contains(string_split(motivos, ','), 'valor_nao_positivo')"
            " ORDER BY arquivo_origem, linha_origem LIMIT 5"
        ),
        "q_reconcile": q(
            "SELECT entidade, qtd_recebidos, qtd_aceitos,"
            f" qtd_recebidos - qtd_aceitos AS rejeitados_distintos {quality_of}"
            " GROUP BY entidade, qtd_recebidos, qtd_aceitos"
        ),
        "q_headline": q(
            "SELECT g.data_aposta AS ultima_data, CAST(sum(g.ggr) AS DECIMAL(22,2)) AS ggr,"
            " CAST(sum(g.exposicao_pendente) AS DECIMAL(22,2)) AS exposicao_pendente,"
            " max(e.apostadores_ativos) AS apostadores_ativos,"
            " (SELECT CAST(avg(taxa_rejeicao) AS DOUBLE) FROM agg_qualidade"
            "  WHERE lote_data = (SELECT max(data_aposta) FROM agg_ggr)) AS taxa_rejeicao_media"
            " FROM agg_ggr g LEFT JOIN agg_engajamento e ON e.data_aposta = g.data_aposta"
            " WHERE g.data_aposta = (SELECT max(data_aposta) FROM agg_ggr) GROUP BY 1"
        ),
        "q_series": q(
            "SELECT data_aposta, esporte, ggr, exposicao_pendente FROM agg_ggr"
            " WHERE esporte IN ('futebol','basquete')"
        ),
        "q_bars": q(
            "SELECT lote_data, motivo,"
            " CAST(sum(qtd_rejeitados_distintos) AS BIGINT) AS qtd_rejeitados_distintos"
            " FROM agg_qualidade WHERE motivo <> 'sem_rejeicao' GROUP BY 1, 2"
        ),
        "q_unpivot": q(
            "SELECT data_transacao, 'total_depositado' AS tipo, total_depositado AS valor"
            " FROM agg_financeiro UNION ALL"
            " SELECT data_transacao, 'total_sacado', total_sacado FROM agg_financeiro"
        ),
        "q_distinct_motivos": q(
            "SELECT DISTINCT motivo FROM agg_qualidade WHERE entidade = 'apostas'"
        ),
        "q_prefix": q("SELECT * FROM fct_apostas WHERE aposta_id LIKE '12%'"),
        "q_state_probe": q(_probes()),
    }
    return texts


# --- generator: the same seeded draws in SQL -----------------------------------------------


def _word(seed: int, label: str, key: str, number: int) -> str:
    block, slot = divmod(number, 2)
    text = f"'{seed}|{label}|{block}|' || CAST({key} AS VARCHAR)"
    return f"CAST('0x' || substr(md5({text}), {16 * slot + 1}, 15) AS BIGINT)"


def _below(word: str, bound: int | str) -> str:
    """A 60-bit word as a number below a bound."""
    return f"CAST(CAST({word} AS HUGEINT) * {bound} // {1 << 60} AS BIGINT)"


def _cents(word: str, low: int, high: int, kind: str) -> str:
    return f"CAST(({_below(word, high - low + 1)} + {low}) / 100.0 AS DECIMAL({kind}))"


def _lists(*values: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# Fixed values.
_STATES = _lists(
    "AC", "AL", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PR", "RJ", "RN", "RS",
    "SC", "SE", "SP", "TO",
)
_SPORTS = ("futebol", "basquete", "tenis", "volei", "mma")
_LEAGUES = tuple(CHAMPIONSHIPS[sport] for sport in _SPORTS)
_TEAMS = tuple(TEAMS[sport] for sport in _SPORTS)


def _event_day(key: str, day: str) -> str:
    return f"(DATE '{day}' + CAST({_below(_word(42, 'evento', key, 0), 26)} - 10 AS INTEGER))"


def _second(word: str, day: str) -> str:
    return f"(TIMESTAMP '{day} 00:00:00' + to_seconds({_below(word, 86400)}))"


def _generated(day: str, suffix: str = "") -> str:
    compact = day.replace("-", "")
    bet = lambda n: _word(42, "aposta", "o_orderkey", n)
    event = lambda n: _word(42, "evento", "p_partkey", n)
    cash = lambda n: _word(42, "transacao", "event_id", n)
    registered = (
        f"(DATE '2024-01-01' + CAST({_below(_word(42, 'apostador', 'c_custkey', 0), 731)} AS INTEGER))"
    )
    nested = lambda groups: "[" + ", ".join(_lists(*g) for g in groups) + "]"
    return f"""
ger_apostadores{suffix} AS (
  SELECT 'APT' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS apostador_id,
         {registered} AS criado_em,
         {_STATES}[{_below(_word(42, "apostador", "c_custkey", 1), 23)} + 1] AS estado,
         CAST({registered} AS TIMESTAMP) AS atualizado_em
  FROM customer
),
ger_eventos{suffix} AS (
  SELECT 'EVT{compact}' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS evento_id,
         {_lists(*_SPORTS)}[s] AS esporte, ligas[{_below("liga", "len(ligas)")} + 1] AS campeonato,
         times[{_below("casa", "len(times)")} + 1] AS time_casa,
         times[({_below("casa", "len(times)")} + 1 + {_below("passo", "(len(times) - 1)")}) % len(times) + 1] AS time_visitante,
         {_event_day("p_partkey", day)} AS data_evento, atualizado_em
  FROM (SELECT *, {nested(_TEAMS)}[s] AS times, {nested(_LEAGUES)}[s] AS ligas
        FROM (SELECT p_partkey, {_below(event(1), 5)} + 1 AS s, {event(2)} AS casa, {event(3)} AS passo,
                     {event(4)} AS liga, {_second(event(5), day)} AS atualizado_em FROM part))
),
ger_apostas{suffix} AS (
  SELECT 'APS{compact}' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS aposta_id,
         'APT' || lpad(CAST(apostador AS VARCHAR), 7, '0') AS apostador_id,
         'EVT{compact}' || lpad(CAST(evento AS VARCHAR), 5, '0') AS evento_id,
         least({_event_day("evento", day)}, DATE '{day}') + CAST(antes AS INTEGER) AS data_aposta,
         valor_apostado, odd, status,
         CASE WHEN status = 'ganha' THEN CAST(valor_apostado * odd AS DECIMAL(12,2))
              ELSE CAST(0 AS DECIMAL(12,2)) END AS premio_pago,
         atualizado_em, evento
  FROM (SELECT o_orderkey, {_below(bet(0), "(SELECT count(*) FROM part)")} AS evento,
               {_below(bet(1), "(SELECT count(*) FROM customer)")} AS apostador,
               {_below(bet(2), 11)} - 10 AS antes,
               {_cents(bet(3), 500, 50000, "12,2")} AS valor_apostado,
               {_cents(bet(4), 120, 800, "8,2")} AS odd,
               CASE WHEN {_below(bet(5), 100)} < 28 THEN 'ganha' WHEN {_below(bet(5), 100)} < 80 THEN 'perdida'
                    WHEN {_below(bet(5), 100)} < 95 THEN 'pendente' ELSE 'cancelada' END AS status,
               {_second(bet(6), day)} AS atualizado_em
        FROM orders)
),
ger_transacoes{suffix} AS (
  SELECT 'TRX{compact}' || lpad(CAST(event_id AS VARCHAR), 7, '0') AS transacao_id,
         'APT' || lpad(CAST({_below(cash(2), "(SELECT count(*) FROM customer)")} AS VARCHAR), 7, '0') AS apostador_id,
         DATE '{day}' AS data_transacao,
         CASE WHEN {_below(cash(0), 2)} = 0 THEN 'deposito' ELSE 'saque' END AS tipo,
         CASE WHEN {_below(cash(0), 2)} = 0 THEN {_cents(cash(1), 2000, 80000, "12,2")}
              ELSE {_cents(cash(1), 5000, 150000, "12,2")} END AS valor,
         {_second(cash(3), day)} AS atualizado_em
  FROM events
)"""


def _dirtied(day: str, suffix: str = "") -> str:
    draw = lambda n: _word(43, "defeito", "aposta_id", n)
    order = "md5('43|defeito|0|' || aposta_id), aposta_id"
    blank = lambda i: f"pos >= d AND pos < d + n AND {_below(draw(7), 5)} = {i}"
    value = (
        f"CASE WHEN pos >= d + n AND pos < d + n + v THEN CASE WHEN {_below(draw(4), 2)} = 0"
        f" THEN CAST(0 AS DECIMAL(12,2)) ELSE -{_cents(draw(5), 100, 30000, '12,2')} END"
        " ELSE valor_apostado END"
    )
    date = (
        f"CASE WHEN pos >= d + n + v AND pos < d + n + v + t THEN {_event_day('evento', day)}"
        f" + CAST({_below(draw(6), 5)} + 1 AS INTEGER) ELSE data_aposta END"
    )
    return f"""
ordenadas{suffix} AS (
  SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS pos,
         CAST(floor(total * 0.05) AS BIGINT) AS d, CAST(floor(total * 0.03) AS BIGINT) AS n,
         CAST(floor(total * 0.02) AS BIGINT) AS v, CAST(floor(total * 0.02) AS BIGINT) AS t
  FROM ger_apostas{suffix}, (SELECT count(*) AS total FROM orders)
),
sujas{suffix} AS (
  SELECT aposta_id, CASE WHEN {blank(0)} THEN NULL ELSE apostador_id END AS apostador_id,
         CASE WHEN {blank(1)} THEN NULL ELSE evento_id END AS evento_id,
         CASE WHEN {blank(2)} THEN NULL ELSE {date} END AS data_aposta,
         CASE WHEN {blank(3)} THEN NULL ELSE {value} END AS valor_apostado,
         odd, CASE WHEN {blank(4)} THEN NULL ELSE status END AS status, premio_pago, atualizado_em
  FROM ordenadas{suffix}
  UNION ALL
  SELECT aposta_id, apostador_id, evento_id, data_aposta,
         CAST(valor_apostado * {_cents(draw(8), 105, 150, "8,2")} AS DECIMAL(12,2)), odd, status,
         premio_pago, atualizado_em + to_seconds({_below(draw(9), 3600)} + 1)
  FROM ordenadas{suffix} WHERE pos < d
)"""


def _resolved_sql(earlier: str, day: str) -> str:
    key = "aposta_id || '|' || CAST(valor_apostado AS VARCHAR)"
    draw = lambda n: _word(42, f"resolucao|{earlier}|{day}", f"({key})", n)
    return f"""
pendentes AS (
  SELECT *, row_number() OVER (ORDER BY aposta_id, valor_apostado, atualizado_em) - 1 AS pos,
         count(*) OVER () AS total
  FROM sujas WHERE status = 'pendente' AND apostador_id IS NOT NULL AND evento_id IS NOT NULL
    AND data_aposta IS NOT NULL AND valor_apostado IS NOT NULL AND odd IS NOT NULL
),
resolvidas AS (
  SELECT aposta_id, apostador_id, evento_id, data_aposta, valor_apostado, odd, novo AS status,
         CASE WHEN novo = 'ganha' THEN CAST(valor_apostado * odd AS DECIMAL(12,2))
              ELSE CAST(0 AS DECIMAL(12,2)) END AS premio_pago, marca AS atualizado_em
  FROM (SELECT *, CASE WHEN {_below(draw(0), 100)} < 35 THEN 'ganha' ELSE 'perdida' END AS novo,
               {_second(draw(1), day)} AS marca
        FROM pendentes WHERE pos < CAST(floor(total * 0.6) AS BIGINT))
)"""


def _text_of(entity: str) -> str:
    return ", ".join(f"nullif({c}, '') AS {c}" for c in _COLUMNS[entity])


def io_oracle() -> dict[str, str]:
    generated = _generated("2026-02-03")
    dirty = ",".join([generated, _dirtied("2026-02-03")])
    resolved = ",".join([dirty, _resolved_sql("2026-02-03", "2026-02-04")])
    next_lot = ",".join(
        [resolved, _generated("2026-02-04", "_2"), _dirtied("2026-02-04", "_2")]
    )
    bet_columns = ", ".join(_COLUMNS["apostas"])
    regenerated = (
        "SELECT * FROM raw_apostas WHERE lote_data <> DATE '1998-01-01'"
        " OR NOT (valor_apostado LIKE '-%' OR valor_apostado = '0.00')"
    )
    printed = " || chr(2) || ".join(
        f"coalesce(CAST({c} AS VARCHAR), chr(1))"
        for c in (
            "aposta_id apostador_id evento_id data_aposta esporte valor_apostado odd status"
            " premio_pago resultado_casa atualizado_em lote_data"
        ).split()
    )
    filled = (
        "aposta_id apostador_id evento_id data_aposta valor_apostado status premio_pago"
        " atualizado_em"
    ).split()
    tables = {
        "fct_apostas": "fct_apostas", "fct_transacoes": "fct_transacoes",
        "dim_apostadores": "cln_apostadores", "dim_eventos": "cln_eventos",
        "agg_ggr_diario_esporte": "agg_ggr", "agg_engajamento_diario": "agg_engajamento",
        "agg_financeiro_diario": "agg_financeiro",
    }
    return {
        "src_csv_lot": q(
            f"SELECT {_text_of('apostas')}, TIMESTAMP '2026-02-03 12:00:00' AS carregado_em,"
            " DATE '2026-02-03' AS lote_data FROM raw_apostas"
        ),
        "src_failfast": q(f"SELECT {_text_of('transacoes')} FROM raw_transacoes"),
        "src_provenance": "SELECT count(*) AS linhas, TRUE AS numeracao_exata FROM orders",
        "src_lot_manifest": (
            "SELECT entidade, TRUE AS presente FROM (VALUES ('apostadores'), ('eventos'),"
            " ('apostas'), ('transacoes')) v(entidade)"
        ),
        "sink_csv": q(
            "SELECT transacao_id, apostador_id, CAST(data_transacao AS VARCHAR) AS data_transacao,"
            " tipo, CAST(valor AS VARCHAR) AS valor,"
            " strftime(atualizado_em, '%Y-%m-%d %H:%M:%S') AS atualizado_em FROM ger_transacoes",
            generated,
        ),
        "sink_fingerprint": q(
            "SELECT count(*) AS linhas, CAST(sum(CAST('0x' || substr(md5("
            f"{printed}), 1, 15) AS BIGINT)) AS DECIMAL(38,0)) AS impressao FROM fct_apostas"
        ),
        "sink_replace_batch": q(regenerated),
        "obs_counts": q(
            "SELECT 'raw_apostas' AS tabela,"
            f" (SELECT count(*) FROM ({regenerated}) WHERE lote_data = DATE '1998-01-01')"
            " AS linhas_escritas,"
            " (SELECT count(*) FROM raw_apostas WHERE lote_data = DATE '1998-01-01')"
            f" AS linhas_removidas, (SELECT count(*) FROM ({regenerated})) AS linhas_total"
        ),
        "gate": q(
            " UNION ALL ".join(
                f"SELECT 'not_null {c}' AS teste, count(*) AS linhas FROM tip_apostas"
                f" WHERE {c} IS NULL"
                for c in filled
            )
            + " UNION ALL SELECT 'accepted_values status', count(*) FROM tip_apostas"
            " WHERE status NOT IN ('ganha','perdida','pendente','cancelada')"
            " UNION ALL SELECT 'unique aposta_id', count(*) FROM (SELECT aposta_id"
            " FROM tip_apostas GROUP BY 1 HAVING count(*) > 1)"
            " UNION ALL SELECT 'relationships evento_id', count(DISTINCT evento_id)"
            " FROM tip_apostas WHERE evento_id NOT IN (SELECT evento_id FROM cln_eventos)"
        ),
        "gen_profile": (
            "SELECT n AS apostas, greatest(1, n // 10) AS apostadores,"
            " greatest(1, n // 60) AS eventos, greatest(1, n // 4) AS transacoes,"
            " CAST(floor(n * 0.05) AS BIGINT) AS duplicata,"
            " CAST(floor(n * 0.03) AS BIGINT) AS nulo_obrigatorio,"
            " CAST(floor(n * 0.02) AS BIGINT) AS valor_nao_positivo,"
            " CAST(floor(n * 0.02) AS BIGINT) AS data_posterior_ao_evento"
            " FROM (SELECT count(*) AS n FROM orders)"
        ),
        "gen_apostadores": q("SELECT * FROM ger_apostadores", generated),
        "gen_eventos": q("SELECT * FROM ger_eventos", generated),
        "gen_apostas": q(f"SELECT {bet_columns} FROM ger_apostas", generated),
        "gen_transacoes": q("SELECT * FROM ger_transacoes", generated),
        "gen_defeitos": q("SELECT * FROM sujas", dirty),
        "gen_pendentes": q("SELECT * FROM resolvidas", resolved),
        "gen_lote": q("SELECT * FROM sujas_2 UNION ALL SELECT * FROM resolvidas", next_lot),
        "replay": q(
            " UNION ALL ".join(
                f"SELECT '{name}' AS tabela, count(*) AS linhas, TRUE AS igual FROM {relation}"
                for name, relation in tables.items()
            )
            + " UNION ALL SELECT 'agg_qualidade_lote', count(*), TRUE FROM (SELECT DISTINCT"
            " entidade, motivo FROM quarentena_lote)",
            FULL + """,
quarentena_lote AS (
  SELECT entidade, unnest(string_split(motivos, ',')) AS motivo FROM quarentena
)""",
        ),
    }
