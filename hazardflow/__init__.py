"""hazardflow: earthquake and weather-alert feeds as Spark DataFrame transforms.

Layers: ``sources`` (scans, parsers, sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (whole
jobs and report tables) and ``streaming`` (the same steps on streams).
"""
