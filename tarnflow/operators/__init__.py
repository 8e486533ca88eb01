"""DataFrame -> DataFrame operators, chained with ``.transform``."""
