"""tessera: composable Spark DataFrame operators for tabular features, ordered
sensor series, text features and evaluation.

Every public operator is a plain function ``DataFrame -> DataFrame`` (usable with
``DataFrame.transform``) or a function returning a ``Column`` expression. The work
is declared with the DataFrame API so Catalyst prunes, pushes down and plans it.
"""

__version__ = "0.1.0"
