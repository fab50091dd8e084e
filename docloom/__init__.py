"""docloom: document-corpus operators expressed as Spark DataFrame plans."""
