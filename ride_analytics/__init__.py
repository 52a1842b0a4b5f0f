"""Trip-record analytics and fare modelling as Spark DataFrame operators."""
