"""DataFrame -> DataFrame operators. Use them with ``df.transform(op, *args)``."""
