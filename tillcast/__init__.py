"""tillcast: invoice analytics and revenue forecasting as Spark DataFrame jobs."""
