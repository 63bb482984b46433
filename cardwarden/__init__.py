"""Card-payment fraud and login-security analytics on Spark DataFrames."""

__version__ = "0.1.0"
