"""Writers: extracted records, index rows, topics."""
