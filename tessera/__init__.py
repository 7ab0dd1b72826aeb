"""tessera: telemetry heatmaps and table preparation as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function (chainable with
``DataFrame.transform``) or a ``Column`` expression builder.  Nothing here
collects data to the driver except where noted (bounded size checks).
"""

__version__ = "0.1.0"
