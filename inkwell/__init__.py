"""inkwell: a Spark-native feature engine for news-article corpora.

Every operator is a plain function over DataFrames (or a Column expression)
so that Catalyst sees one declarative plan per query.  Sub-packages:

* ``sources``   - readers and writers (article JSON, NDJSON, CSV, word vectors,
                  enriched sink, topic snapshot, model artifacts)
* ``functions`` - Column expressions: field projections, predicates, text
                  cleaning, score mappings, vector maths
* ``operators`` - DataFrame -> DataFrame operators: keyword labelling, entity
                  enrichment, sentiment, embeddings, classifiers, evaluation
* ``plans``     - composite plans (article feature record, corpus enrichment,
                  search records) and stand-in views derived from driver tables
* ``streaming`` - incremental corpus enrichment with Structured Streaming
"""

__version__ = "0.1.0"
