"""tallyloom: Spark DataFrame operators and plans for periodic submission reporting."""

__version__ = "0.1.0"
