"""quernstone.functions"""
