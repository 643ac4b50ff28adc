"""siltstone.streaming"""
