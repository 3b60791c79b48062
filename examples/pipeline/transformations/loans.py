from pyspark.sql import SparkSession

from ledgerline.plans.declarative import define_loan_pipeline

spark = SparkSession.active()
define_loan_pipeline(spark, spark.conf.get("ledgerline.loans.raw_path"))
