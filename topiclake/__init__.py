"""topiclake: topics of JSON messages to bronze / silver / gold tables on Spark.

Everything is expressed with the DataFrame / SQL API so that Catalyst plans
the work; the same transforms run on bounded (``spark.read``) and unbounded
(``spark.readStream``) frames.
"""

__version__ = "0.1.0"
