"""quernstone.streaming"""
