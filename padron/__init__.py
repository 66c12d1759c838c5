"""Entity resolution for organisation registers, written as PySpark DataFrame operators."""
