"""billforge.functions"""
