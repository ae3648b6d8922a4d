"""quernstone.sources"""
