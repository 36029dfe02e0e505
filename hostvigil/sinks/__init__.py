"""Writing landed tables, results and topics."""
