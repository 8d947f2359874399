"""babelmill: multilingual knowledge-base flows as Spark plans."""
