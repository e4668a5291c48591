"""Set-based PySpark operators for price bars, trades, holdings, securities and exchange rates."""
