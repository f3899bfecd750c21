"""cadastra.sources"""
