"""The documented questions asked in SQL over the published views."""

from conftest import LOT, RUN_AT, Raw

from lotforge.model import ENTITIES
from lotforge.plans.batch import MARTS, run_batch
from lotforge.plans.views import register_views
from lotforge.sinks.csv_lots import write_text
from lotforge.sinks.store import LotStore


def test_sql_questions(spark, tmp_path):
    raw = Raw(spark).bettor().event(sport="mma").event("F", sport="tenis")
    raw.bet("1", stake="10").bet("2", event="F", status="ganha", prize="50").bet("3", stake="-4")
    raw.cash("in").cash("out", kind="saque", value="80")
    for name, df in raw.frames().items():
        write_text(df, ENTITIES[name], LOT, str(tmp_path / "lots"))
    store = LotStore(spark, str(tmp_path / "store"))
    run_batch(spark, str(tmp_path / "lots"), LOT, RUN_AT, store)
    names = register_views(store)
    assert {"raw_apostas", "stg_apostas", "stg_apostas_rejeitadas", "fct_apostas",
            "qua_registros_rejeitados", "dim_eventos", "agg_qualidade_lote"} <= set(names)

    def ask(sql):
        return [tuple(map(str, r)) for r in spark.sql(sql).collect()]

    assert ask(
        "SELECT esporte, ggr FROM agg_ggr_diario_esporte"
        " WHERE data_aposta = '2026-02-01' ORDER BY ggr DESC"
    ) == [("mma", "10.00"), ("tenis", "-40.00")]
    assert ask("SELECT volume_apostado, qtd_apostas FROM agg_engajamento_diario") == [("20.00", "2")]
    assert ask("SELECT liquido FROM agg_financeiro_diario ORDER BY data_transacao DESC") == [("-30.00",)]
    assert ask(
        "SELECT entidade, motivo, qtd_rejeitados, taxa_rejeicao FROM agg_qualidade_lote"
        " WHERE lote_data = '2026-02-03' AND entidade = 'apostas'"
    ) == [("apostas", "valor_nao_positivo", "1", "0.3333")]
    assert ask(
        "SELECT chave_natural, linha_origem, registro_original:valor_apostado::string"
        " FROM qua_registros_rejeitados WHERE lote_data = '2026-02-03'"
        " AND array_contains(motivos, 'valor_nao_positivo') LIMIT 5"
    ) == [("3", "4", "-4")]
    assert "never be added to ggr" in store.note(MARTS, "agg_ggr_diario_esporte")
