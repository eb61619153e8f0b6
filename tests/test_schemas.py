"""Operators produce the declared layer schemas."""

from vaultline import bindings as B
from vaultline.operators import cdc, incremental as inc, monitoring
from vaultline.schemas import CTL_LOAD, METRICS, STG_CDC_CARD, STG_CDC_TRANSACTION


def _shape(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_landing_and_control_schemas(spark, sf_dir):
    d = cdc.decode_envelope(B.cdc_records(spark, sf_dir))
    assert _shape(cdc.land_cards(d).drop("ingested_at").schema) == _shape(STG_CDC_CARD)
    assert _shape(cdc.land_transactions(d).drop("ingested_at").schema) == \
        _shape(STG_CDC_TRANSACTION)
    assert _shape(inc.watermark_row(spark, "p", "t", 1, "2025-01-01 00:00:00").schema) == \
        _shape(CTL_LOAD)
    end, committed = B.offsets(spark, sf_dir)
    m = monitoring.lag_metrics(monitoring.kafka_lag(end, committed), "g", "2025-01-01 00:00:00")
    assert _shape(m.schema) == _shape(METRICS)
