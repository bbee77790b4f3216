"""tallyspark: daily, weekly and monthly player KPIs on Spark.

Every roll-up is a pure function of input DataFrames and a set of run dates;
writing results is a separate step (see ``tallyspark.sinks``).
"""

__version__ = "0.1.0"
