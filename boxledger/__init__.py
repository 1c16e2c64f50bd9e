"""boxledger: DataFrame operators for box-office, fundraising and ledger analytics on Spark."""

__version__ = "0.1.0"
