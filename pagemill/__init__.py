"""pagemill: web-page retrieval and content analytics as Spark DataFrame operators.

URLs, raw responses, rendered pages, links, images, feeds, tables and ranked
search results are DataFrames; every operator is a function from DataFrames and
parameters to a DataFrame.
"""

__version__ = "0.1.0"
