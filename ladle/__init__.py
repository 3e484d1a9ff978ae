"""ladle: item-quality ranking, evaluation and monitoring as Spark DataFrame operators."""
