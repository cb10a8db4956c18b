"""dealspark.functions"""
