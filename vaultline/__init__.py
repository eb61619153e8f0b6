"""vaultline: bank-transaction warehouse operators on Spark DataFrames.

Every public function takes DataFrames (or a streaming DataFrame) and returns
DataFrames; planning is left to Catalyst/AQE. Nothing is collected to the
driver except scalar watermarks and bounded lists of partition values.

The most used operators are re-exported here; the modules under
``vaultline.operators``, ``sources``, ``sinks``, ``streaming`` and ``plans``
hold the rest.
"""

from vaultline.operators.cdc import (card_versions, decode_envelope, dedupe_log, land_cards,
                                     land_transactions, raw_transaction_cdc)
from vaultline.operators.facts import (active_cards, customers_without_active_accounts,
                                       fact_atm_transaction)
from vaultline.operators.fraud import amount_probe, rapid_withdrawals, used_after_block
from vaultline.operators.incremental import delta, high_watermark, latest_per_key, upsert
from vaultline.operators.scd2 import as_of, scd2, scd2_current, scd2_incremental
from vaultline.sinks.tables import TableStore
from vaultline.sources.extract import extract_incremental, extract_snapshot

__version__ = "0.1.0"

__all__ = [
    "TableStore", "active_cards", "amount_probe", "as_of", "card_versions",
    "customers_without_active_accounts", "decode_envelope", "dedupe_log", "delta",
    "extract_incremental", "extract_snapshot", "fact_atm_transaction", "high_watermark",
    "land_cards", "land_transactions", "latest_per_key", "rapid_withdrawals",
    "raw_transaction_cdc", "scd2", "scd2_current", "scd2_incremental", "upsert",
    "used_after_block",
]
