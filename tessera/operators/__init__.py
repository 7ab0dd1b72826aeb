"""DataFrame -> DataFrame operators, chainable with ``DataFrame.transform``."""
