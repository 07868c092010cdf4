"""DataFrame -> DataFrame steps, chained with ``DataFrame.transform``."""
