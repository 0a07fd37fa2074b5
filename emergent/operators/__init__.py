"""DataFrame -> DataFrame operators of the contrast-mining engine."""
