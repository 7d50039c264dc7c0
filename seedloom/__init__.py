"""Spark operators that prepare, mix, format and judge text-to-SQL training examples."""
