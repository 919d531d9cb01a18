"""Column expressions (no UDFs): codecs, date-time text, geography, ranges."""
