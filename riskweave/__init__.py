"""Card-transaction risk analytics on PySpark: batch, streaming and serving."""
