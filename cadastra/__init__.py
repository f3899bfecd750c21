"""cadastra: address-to-territory analytics and corpus preparation on Spark."""
