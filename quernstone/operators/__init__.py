"""quernstone.operators"""
